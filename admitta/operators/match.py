"""Similarity search of programmes among table rows (J1 to J5, W4, O3) with the fuzzy ratios.

Every row of a programme's faculty is a candidate, whatever its name, so the search is a query set
against all rows in blocks: the distinct forms of both sides are cut into blocks of a bounded size, a
task scores one block of programmes against one block of rows, and only the best two rows of each
programme leave it. A faculty of any size hence spreads over as many tasks as it has pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitta.functions.fuzzy import Bounds, partial, partial_ratio, partial_ratios, token_set, token_set_ratios
from admitta.functions.text import expand_abbreviations, match_form

#: Weights, the name score below which nothing counts, and the status thresholds.
NAME, LEVEL, DOMAIN, LEAST_NAME, KEPT, CLOSE, LOW, ACCEPTED = 0.5, 0.3, 0.2, 0.3, 0.01, 0.15, 0.5, 0.65
DOMAIN_ALIKE, GRADE_ALIKE = 80, 85
#: Distinct forms of a group in one block, about; of programmes and of rows where the best two are searched.
BLOCK, QUERIES, ROWS = 128, 512, 8192
#: Rows of a programme that are compared first, and what rounding may take from a bound.
SEEDS, SLACK = 4, 1e-9
#: Pairs whose subsequences are counted at a time, about.
TOGETHER = 1 << 19

Found = Iterator[tuple[int, dict]]


def comparable(name: Column) -> Column:
    return expand_abbreviations(match_form(name))


def levels_conflict(a: Column, b: Column) -> Column:
    lic = lambda c: F.contains(c, F.lit("licenta")) | F.contains(c, F.lit("licență"))
    mas = lambda c: F.contains(c, F.lit("master"))
    return (b != "") & ((lic(a) & mas(b)) | (mas(a) & lic(b)))


def level_signal(a: Column, b: Column) -> Column:
    inside = F.contains(a, b) | F.contains(b, a)
    return F.when((a != "") & (b != ""), F.when(inside, 1.0).otherwise(0.0)).when((a == "") & (b == ""), 0.5).otherwise(0.0)


def composite(name_score: Column, level_score: Column, domain_score: Column) -> Column:
    """J2 from its parts."""
    total = NAME * name_score + LEVEL * level_score + DOMAIN * domain_score
    return F.when(name_score < LEAST_NAME, 0.0).otherwise(F.least(total, F.lit(1.0)))


def pair_scores(pairs: DataFrame) -> DataFrame:
    """``score`` of given pairs (a, la, da, b, lb, db: comparable names, lower-case levels and domains)."""
    raw = pairs.withColumn("_t", token_set("a", "b")).withColumn("_p", partial("a", "b")).withColumn("_d", partial("da", "db"))
    domain = F.when((F.col("da") != "") & (F.col("db") != "") & (F.col("_d") > DOMAIN_ALIKE), 1.0).otherwise(0.0)
    score = composite(F.greatest("_t", "_p") / 100.0, level_signal(F.col("la"), F.col("lb")), domain)
    return raw.withColumn("score", F.when(levels_conflict(F.col("la"), F.col("lb")), 0.0).otherwise(score)).drop("_t", "_p", "_d")


def _blocks(items: DataFrame, on: Sequence[str], side: str, block: int) -> tuple[DataFrame, DataFrame]:
    """Items (on, item) in blocks by hash, and the number of blocks of each group."""
    sizes = items.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(f"{side}_blocks"))
    placed = items.join(sizes, list(on)).withColumn(side, F.pmod(F.xxhash64("item"), F.col(f"{side}_blocks")).cast("int"))
    return placed.groupBy(*on, side).agg(F.collect_list("item").alias(f"{side}_items")), sizes


def search(queries: DataFrame, rows: DataFrame, on: Sequence[str], best: Callable[[list[dict], list[dict]], Found], found: str, blocks: tuple[int, int] | None = None) -> DataFrame:
    """(on, query, found fields): what ``best`` yields for blocks of queries and rows that agree in ``on``.

    ``queries`` and ``rows`` are (on, item) with struct items; ``best`` gets a block of each and yields
    (position of the query, fields). Groups that are null or on one side only give nothing. ``blocks`` are
    the forms in a block of queries and in one of rows.
    """
    on = list(on)
    q_block, r_block = blocks or (BLOCK, BLOCK)
    q_blocks, q_sizes = _blocks(queries, on, "q", q_block)
    r_blocks, r_sizes = _blocks(rows, on, "r", r_block)
    left = q_blocks.join(r_sizes, on).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("r_blocks") - 1)))
    right = r_blocks.join(q_sizes, on).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    pairs = left.join(right, [*on, "q", "r"]).select(F.struct(*on).alias("g"), "q_items", "r_items")
    # few bytes and much work: the blocks must not be put together into few tasks for their size
    spark = pairs.sparkSession
    pairs = pairs.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))
    kind = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}
    schema = f"g {kind['g']}, query {kind['q_items'][6:-1]}, found struct<{found}>"
    types = pairs.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        for batch in batches:
            for g, qs, rs in ((c[k].as_py() for c in batch.columns) for k in range(batch.num_rows)):
                out = [{"g": g, "query": qs[i], "found": fields} for i, fields in best(qs, rs)]
                yield pa.RecordBatch.from_pylist(out, to_arrow_schema(types))

    return pairs.mapInArrow(run, schema).select("g.*", "query", "found.*")


def _level_parts(la: str, lb: str) -> tuple[bool, float]:
    lic, mas = [("licenta" in x or "licență" in x) for x in (la, lb)], ["master" in x for x in (la, lb)]
    conflict = lb != "" and ((lic[0] and mas[1]) or (mas[0] and lic[1]))
    if la and lb:
        return conflict, 1.0 if la in lb or lb in la else 0.0
    return conflict, 0.5 if not la and not lb else 0.0


def _distinct(values: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct values, and the place of each value among them."""
    known = sorted(set(values))
    place = {v: k for k, v in enumerate(known)}
    return known, np.array([place[v] for v in values])


@lru_cache(1 << 16)
def _domains_alike(da: str, db: str) -> bool:
    return bool(da and db) and partial_ratio(da, db) > DOMAIN_ALIKE


def best_two(queries: list[dict], rows: list[dict]) -> Found:
    """The best two rows of each programme.

    Level and domain bound what a pair can reach, and so do the words, characters and subsequences that
    two names share. The likeliest rows of a programme are compared first; of the others those whose
    bound is not below the second best score, from the largest bound down.
    """
    names = [q["a"] for q in queries], [r["b"] for r in rows]
    bounds = Bounds(*names)
    twice = [r["rid"] != r["last_rid"] for r in rows]
    (lbs, lb), (dbs, db) = (_distinct([r[c] for r in rows]) for c in ("lb", "db"))
    kinds: dict[tuple[str, str], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for la, da in {(q["la"], q["da"]) for q in queries}:
        conflict, level = (np.array(x)[lb] for x in zip(*(_level_parts(la, y) for y in lbs)))
        rest, domain = LEVEL * level, DOMAIN * np.array([float(_domains_alike(da, y)) for y in dbs])[db]
        kinds[la, da] = rest, domain, np.where(conflict, 0.0, np.minimum(NAME + rest + domain, 1.0))
    kind = [kinds[q["la"], q["da"]] for q in queries]
    first, second = np.zeros(len(queries)), np.zeros(len(queries))
    scored: list[list[tuple[float, int]]] = [[] for _ in queries]

    def reach(at: np.ndarray, name: np.ndarray, rest: np.ndarray, domain: np.ndarray) -> np.ndarray:
        """Whether pairs with this name score can be among the best two."""
        return NAME * name + rest + domain >= np.maximum(second[at], KEPT) - SLACK

    def compare(i: np.ndarray, j: np.ndarray, rest: np.ndarray, domain: np.ndarray, sets: np.ndarray, stretches: np.ndarray) -> None:
        name = np.zeros(len(i))
        for ratios, most in ((token_set_ratios, sets), (partial_ratios, stretches)):
            at = np.flatnonzero(reach(i, most, rest, domain) & (most + SLACK > name))
            if len(at):
                name[at] = np.maximum(name[at], ratios([names[0][k] for k in i[at]], [names[1][k] for k in j[at]]) / 100.0)
        total = np.where(name < LEAST_NAME, 0.0, np.minimum(NAME * name + rest + domain, 1.0))
        for q, r, s in zip(i.tolist(), j.tolist(), total.tolist()):
            if s <= KEPT or s < second[q]:
                continue
            scored[q].append((s, r))
            for _ in range(1 + twice[r]):
                if s > first[q]:
                    first[q], second[q] = s, first[q]
                elif s > second[q]:
                    second[q] = s

    def pairs(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*parts)]

    shared = [bounds.shared(q) for q in range(len(queries))]
    seeds = []
    for q, (rest, domain, most) in enumerate(kind):
        low = np.where(most > KEPT, NAME * bounds.least(q, *shared[q]) + rest + domain, -1.0)
        j = np.argpartition(low, -SEEDS)[-SEEDS:] if len(low) > SEEDS else np.arange(len(low))
        j = j[most[j] > KEPT]
        seeds.append((np.full(len(j), q), j, rest[j], domain[j]))
    i, j, rest, domain = pairs(seeds)
    compare(i, j, rest, domain, np.ones(len(i)), np.ones(len(i)))
    def settle(left: list[tuple[np.ndarray, ...]]) -> None:
        i, j, rest, domain, count, length = pairs(left)
        sets, stretches, common = bounds.by_subsequences(i, j, count, length)
        k = np.flatnonzero(reach(i, stretches, rest, domain))
        stretches[k] = bounds.by_ends(i[k], j[k], common[k])
        bound = NAME * np.maximum(sets, stretches) + rest + domain
        order = np.lexsort((-bound, i))
        place = np.empty(len(i), dtype=np.int64)
        place[order] = np.arange(len(i)) - np.searchsorted(i[order], i[order])
        done, most = 0, SEEDS
        while (place >= done).any():
            k = np.flatnonzero((place >= done) & (place < most) & (bound >= np.maximum(second[i], KEPT) - SLACK))
            compare(i[k], j[k], rest[k], domain[k], sets[k], stretches[k])
            done, most = most, 4 * most

    left, waiting = [], 0
    for q, (rest, domain, most) in enumerate(kind):
        able = most >= max(second[q], KEPT) - SLACK
        able[seeds[q][1]] = False
        j = np.flatnonzero(able)
        count, length = (x[j] for x in shared[q])
        rest, domain, at = rest[j], domain[j], np.full(len(j), q)
        k = np.flatnonzero(reach(at, np.maximum(*bounds.by_bags(q, j, count, length)), rest, domain))
        left.append((at[k], j[k], rest[k], domain[k], count[k], length[k]))
        waiting += len(k)
        if waiting > TOGETHER or q == len(kind) - 1:
            settle(left)
            left, waiting = [], 0
    for q, found in enumerate(scored):
        listed = [(-s, rid) for s, r in found if s >= second[q] for rid in {rows[r]["rid"], rows[r]["last_rid"]}]
        for minus, rid in sorted(listed)[:2]:
            yield q, {"score": -minus, "rid": rid}


def best_rows(programs: DataFrame, rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """Per programme (on, pid) the best row of its group, the score, the status and whether it is accepted.

    ``programs`` has pid, name, level, domain and the ``on`` columns; ``rows`` has rid, program_name,
    level, domain and the ``on`` columns. Of equal scores the smallest rid wins. Programmes without any
    row, null groups among them, stay as ``no_match``; nulls count as empty texts.
    """
    on = list(on)
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    left = programs.select(*on, "pid", F.struct(comparable(F.col("name")).alias("a"), low("level").alias("la"), low("domain").alias("da")).alias("item"))
    right = rows.select(*on, "rid", comparable(F.col("program_name")).alias("b"), low("level").alias("lb"), low("domain").alias("db"))
    # rows of one form score alike: the first two by rid stand for all
    forms = right.groupBy(*on, "b", "lb", "db").agg(F.min("rid").alias("rid"), F.max("rid").alias("last_rid")).select(*on, F.struct("b", "lb", "db", "rid", "last_rid").alias("item"))
    scored = search(left.select(*on, "item").dropDuplicates(), forms, on, best_two, "score:double,rid:string", (QUERIES, ROWS))
    order = Window.partitionBy(*on, "query").orderBy(F.desc("score"), "rid")
    top = scored.withColumn("place", F.row_number().over(order)).where("place <= 2")
    both = top.groupBy(*on, "query").agg(
        F.max(F.when(F.col("place") == 1, F.col("rid"))).alias("rid"), F.max(F.when(F.col("place") == 1, F.col("score"))).alias("score"), F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second")
    )
    out = left.dropDuplicates().join(both.withColumnRenamed("query", "item"), [*on, "item"], "left")
    # a pid of several forms takes the best of them
    best = F.struct(F.coalesce("score", F.lit(0.0)).alias("s"), F.struct("rid", "score", "second").alias("v"))
    out = out.groupBy(*on, "pid").agg(F.max(best)["v"].alias("v")).select(*on, "pid", "v.*")
    status = (
        F.when(F.col("score").isNull(), "no_match").when(F.col("score") < LOW, "low_confidence").when(F.round(F.col("score") - F.col("second"), 9) < CLOSE, "ambiguous").otherwise("match")
    )
    return out.select(*on, "pid", "rid", F.coalesce("score", F.lit(0.0)).alias("score"), status.alias("status"), F.coalesce(F.col("score") > ACCEPTED, F.lit(False)).alias("accepted"))


def best_grade(queries: list[dict], rows: list[dict]) -> Found:
    """The grade whose name is most alike, above the threshold; the first one wins ties."""
    b = [r["b"] for r in rows]
    score = token_set_ratios([q["a"] for q in queries for _ in rows], b * len(queries)).reshape(len(queries), len(rows))
    for i in range(len(queries)):
        able = np.flatnonzero((score[i] > GRADE_ALIKE) & (score[i] == score[i].max()))
        if len(able):
            j = min(able, key=lambda k: rows[k]["key_pos"])
            yield i, {"alike": float(score[i, j]), "key_pos": rows[j]["key_pos"], "grade_key": rows[j]["grade_key"], "min_grade": rows[j]["min_grade"]}


def grade_matches(programs: DataFrame, grades: DataFrame, on: Sequence[str]) -> DataFrame:
    """Per programme the grade (grade_key, min_grade, key_pos) whose name is most alike; programmes without one give no row."""
    on = list(on)
    left = programs.select(*on, "pid", F.struct(match_form(F.col("name")).alias("a")).alias("item"))
    right = grades.select(*on, F.struct(match_form(F.col("grade_key")).alias("b"), "grade_key", F.col("min_grade").cast("double").alias("min_grade"), F.col("key_pos").cast("string").alias("key_pos")).alias("item"))
    alike = search(left.select(*on, "item").dropDuplicates(), right, on, best_grade, "alike:double,key_pos:string,grade_key:string,min_grade:double")
    first = Window.partitionBy(*on, "pid").orderBy(F.desc("alike"), "key_pos")
    best = left.dropDuplicates().join(alike.withColumnRenamed("query", "item"), [*on, "item"]).withColumn("place", F.row_number().over(first)).where("place = 1")
    return best.select(*on, "pid", "grade_key", "min_grade", "alike")
