"""The ratios X1 to X3 in SQL: common subsequences counted with the bits of 128-bit numbers, a bit per character of the shorter string."""

from __future__ import annotations


def _common(size: str, masks: str) -> str:
    full = f"((1::HUGEINT << {size}) - 1)"
    return f"({size} - bit_count(list_reduce({masks}, lambda v, k: ((v + (v & k)) | (v - (v & k))) & {full}, {full})))"


def _masks(short: str, long: str) -> str:
    """Per character of the longer string the bits of its places in the shorter one."""
    return f"list_transform(range(1, length({long}) + 1), lambda j: list_sum(list_transform(range(1, length({short}) + 1), lambda i: CASE WHEN substring({short}, i, 1) = substring({long}, j, 1) THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END))::HUGEINT)"


def ratios(pairs: str) -> str:
    """(a, b, token_set, partial, indel) of the distinct texts (a, b) of ``pairs``, as a query."""
    words = "list_distinct(list_filter(string_split({}, ' '), lambda x: x <> ''))"
    sides = "CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END AS s, CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END AS t"
    return f"""(WITH d AS (SELECT DISTINCT a, b FROM {pairs}),
w AS (SELECT a, b, list_sort(list_intersect({words.format('a')}, {words.format('b')})) AS i, list_sort(list_filter({words.format('a')}, lambda x: NOT list_contains({words.format('b')}, x))) AS x, list_sort(list_filter({words.format('b')}, lambda x: NOT list_contains({words.format('a')}, x))) AS y FROM d),
j AS (SELECT a, b, array_to_string(i, ' ') AS i, array_to_string(list_concat(i, x), ' ') AS l, array_to_string(list_concat(i, y), ' ') AS r, len(i) AS ni, len(x) AS nx, len(y) AS ny FROM w),
texts AS (SELECT DISTINCT s, t FROM (SELECT {sides.format(a='a', b='b')} FROM d UNION ALL SELECT {sides.format(a='l', b='r')} FROM j UNION ALL SELECT b AS s, a AS t FROM d WHERE length(a) = length(b)) WHERE s <> ''),
m AS MATERIALIZED (SELECT s, t, length(s) AS n, length(t) AS z, {_masks('s', 't')} AS mk FROM texts),
c AS (SELECT s, t, 200.0::DOUBLE * {_common('n', 'mk')} / (n + z) AS indel FROM m),
p AS (SELECT s, t, list_max(list_transform(range(1, z + n), lambda e: 200.0::DOUBLE * {_common('n', 'mk[greatest(1, e - n + 1):least(e, z)]')} / (n + least(e, z) - greatest(1, e - n + 1) + 1))) AS part FROM m),
e AS (SELECT j.*, coalesce(c.indel, 0.0) AS whole FROM (SELECT *, {sides.format(a='l', b='r')} FROM j) j LEFT JOIN c ON c.s = j.s AND c.t = j.t),
f AS (SELECT d.a, d.b, max(part) AS part, max(indel) AS indel FROM (SELECT a, b, {sides.format(a='a', b='b')} FROM d UNION ALL SELECT a, b, b AS s, a AS t FROM d WHERE length(a) = length(b)) d JOIN p ON p.s = d.s AND p.t = d.t JOIN c ON c.s = d.s AND c.t = d.t GROUP BY d.a, d.b)
SELECT d.a, d.b, CASE WHEN ni + nx = 0 OR ni + ny = 0 THEN 0.0 WHEN ni > 0 AND (nx = 0 OR ny = 0) THEN 100.0 WHEN ni = 0 THEN whole
ELSE greatest(whole, 200.0::DOUBLE * length(i) / (length(i) + length(l)), 200.0::DOUBLE * length(i) / (length(i) + length(r))) END AS token_set,
CASE WHEN d.a = d.b THEN 100.0 ELSE coalesce(part, 0.0) END AS "partial", CASE WHEN d.a = d.b THEN 100.0 ELSE coalesce(indel, 0.0) END AS indel
FROM d JOIN e ON e.a = d.a AND e.b = d.b LEFT JOIN f ON f.a = d.a AND f.b = d.b)"""
