"""Word lists, tables and thresholds of the rules. Every operator takes them as parameters; these are the defaults.

Fixed values: results depend on each entry and on its order.
"""

from __future__ import annotations

NEGATIVE = [
    "secretariat", "contact", "acasa", "home", "meniu", "search", "regulament", "concurs", "bibliotec", "campus", "cazare", "burse", "orar", "proiect",
    "partener", "despre", "istoric", "conducer", "departament", "login", "harta", "gdpr", "cookies", "anunt", "eveniment", "noutat", "presa", "media",
    "galerie", "admitere", "inscrier", "secretari",
]
POSITIVE = [
    "inginer", "stiint", "limb", "literatur", "studi", "master", "licent", "manag", "drept", "informat", "tehnolog", "matemat", "chimi", "fizic", "biolog",
    "geografi", "istori", "teolog", "arte", "muzic", "teatr", "pedagog", "sport", "educati", "administra", "econom", "finant", "didac", "psiholog", "comunic",
    "sociolog", "arhitect", "construct", "electr", "mecanic", "agronom", "horticult", "silvicult", "marketing", "contab", "statistic", "kinetoterap",
    "farmac",
]
SUFFIXES = ["ologie", "istica", "logie", "grafie", "metrie", "nomic", "genie", "turism", "silvic", "sanitar", "juridic"]
ABBREVIATIONS = {"calc": "calculatoare", "eng": "engleza", "ing": "inginerie", "auto": "automatica", "inf": "informatica", "mas": "master", "lic": "licenta"}
DOCUMENT_TYPES = {
    "SPOTS": ["cifra", "locuri", "capacitate"],
    "RESULTS": ["rezultate", "medii", "admis", "respins", "ierarhie"],
    "GUIDE": ["ghid", "metodologie", "regulament"],
    "EXAM": ["tematica", "subiecte", "grile", "disciplina"],
    "CALENDAR": ["calendar", "programare", "data", "perioada"],
}
#: Types that speak against a wanted type.
AGAINST = {"SPOTS": ["GUIDE", "EXAM", "RESULTS"], "RESULTS": ["GUIDE", "EXAM", "SPOTS"]}
ROW_BLACKLIST = ["total", "copie", "mentiunea", "original", "secretar", "semnatura", "document", "fiecare"]
HEADER_WORDS = ["domeni", "specializ", "program", "studii", "buget", "tax", "cifra", "locuri"]
NAME_HEADERS = ["domeni", "specializ", "program", "studii"]
LIST_NOISE = ["ghid", "tutorial", "documente", "taxe", "înscriere", "calendar", "confirmare"]
LIST_NOISE_MORE = [
    *LIST_NOISE, "modalități", "tematică", "interviu", "contact", "regulament", "concurs", "studenți", "burse", "cazare", "social", "sport",
    "finalizare", "strategia", "proiecte", "cercetare", "declaratii", "structura", "conducere", "acorduri", "baza materială", "orar", "fise", "articole",
    "evenimente", "rezultate", "acte", "dosar", "admitere online",
]
LIST_WHITELIST = [
    "licență", "licenta", "master", "doctorat", "inginerie", "drept", "litere", "științe", "stiinte", "matematică", "fizică", "chimie", "informatică",
    "geografie", "teologie", "istorie", "filosofie", "sociologie", "psihologie", "educație", "administrație", "economie", "finanțe", "management",
    "marketing", "agricultură", "horticultură", "silvicultură", "mediu", "biologie", "peisagistică", "autovehicule", "robotica", "mecatronică", "electrică",
    "energetică", "aerospatiala",
]
NAVIGATION = ["menu", "home", "contact", "hartă", "search", "faq", "cariere"]
NAVIGATION_CLASSES = ["menu", "nav", "footer", "sidebar", "breadcrumb"]
GRADE_LINK_WORDS = ["rezultate", "admis", "liste", "clasament", "medii"]
GRADE_LINK_AGAINST = ["cazare", "burse", "programare"]
CONTAINERS = ("div#continut_standard", "div#main_content", "article", ".entry-content", ".post-content", ".page-content", ".content-area", "main")
NO_CAREER = ["Specific domeniului"]
CAREERS_FIRST = {
    "agricultura": ["Inginer Agronom", "Fermier", "Consultant Agricol"],
    "montanologie": ["Inginer Montan", "Ranger", "Expert Dezvoltare Rurală"],
    "cadastru": ["Inginer Cadastru", "Topograf", "Geodez"],
    "biologie": ["Biolog", "Cercetător", "Profesor"],
    "peisagistic": ["Arhitect Peisagist", "Designer Grădini"],
    "alimentar": ["Inginer Industrie Alimentară", "Controlor Calitate"],
    "horticultur": ["Horticultor", "Manager Fermă"],
    "silvicultur": ["Inginer Silvic", "Pădurar"],
    "mediu": ["Ecolog", "Inspector Protecția Mediului"],
    "management": ["Manager Proiect", "Administrator"],
}
CAREERS_ALL = CAREERS_FIRST | {
    "calc": ["Software Engineer", "Data Analyst", "DevOps"],
    "info": ["Software Engineer", "Data Analyst", "DevOps"],
    "auto": ["Automation Engineer", "Robotics Specialist"],
    "robot": ["Automation Engineer", "Robotics Specialist"],
    "mec": ["Mechanical Engineer", "CAD Designer"],
    "drept": ["Avocat", "Jurist", "Magistrat"],
    "econom": ["Economist", "Analist Financiar"],
    "litere": ["Traducator", "Profesor", "Copywriter"],
    "sport": ["Antrenor", "Profesor Sport", "Kinetoterapeut"],
    "kineto": ["Kinetoterapeut", "Fizioterapeut"],
    "teologie": ["Preot", "Profesor Teologie", "Asistent Social"],
    "istorie": ["Istoric", "Muzeograf", "Arheolog"],
    "geografie": ["Geograf", "Meteorolog", "Hidrolog"],
    "sociologie": ["Sociolog", "Analist Politic", "HR Specialist"],
    "psihologie": ["Psiholog", "Consilier Scolar", "Psihoterapeut"],
}
COUNT_PATTERN = r"(?i)(?:B[:\s]*|B\s*[:]?|locuri(?:\s+la\s+buget)?)[^\d]*(\d+)|(\d+)\s*(?:locuri|cu taxă|taxă)|B:\s*(\d+)\s*T:\s*(\d+)"
NOISE_PATTERN = r"(?i)(^\s*[>!*]+|[*!]{2,}|NOU!|Admiterea.*LICENȚĂ)"
BOTH_PATTERN = r"(?is)(\d+)\s*loc(?:uri)?\s*(?:la\s+)?buget.*?(\d+)\s*loc(?:uri)?\s*(?:cu\s+)?tax"
BUDGET_PATTERN = r"(?i)(\d+)\s*loc(?:uri)?\s*(?:la\s+)?buget"
TAX_PATTERN = r"(?i)(\d+)\s*loc(?:uri)?\s*(?:cu\s+)?tax"
