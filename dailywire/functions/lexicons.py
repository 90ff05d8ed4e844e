"""Built-in word lists and replacement tables.

Every list here is only a default: each operator takes its list as a parameter,
and large lists (the full stop-word file, a sentiment dictionary, a tagger
lexicon) are read as tables with ``dailywire.sources``.
"""

from __future__ import annotations

import unicodedata

# ---------------------------------------------------------------------------
# FIXED VALUES - these must equal the analysed pipeline's values for equal results.
# ---------------------------------------------------------------------------

# Key terms that mark an article as being about covid.
COVID_TERMS = ("covid", "corona", "covid-19", "pandemic")

# Terms that push an article's polarity down by NEGATIVE_TERM_PENALTY per occurrence.
NEGATIVE_TERMS = ("accident", "death", "die", "ban", "desaster", "arrest")
NEGATIVE_TERM_PENALTY = 0.2

# The first 100 entries of the stop-word file, in file order (the benchmark's k = 100 list; T4/T5).
STOPWORDS_FIRST_100 = tuple(
    """about above across after again against all almost alone along already also although always among an
and another any anybody anyone anything anywhere are area areas around as ask asked asking asks at
away b back backed backing backs be became because become becomes been before began behind being
beings best better between big both but by c came can cannot case cases certain certainly clear
clearly come could d did differ different differently do does done down down downed downing downs
during e each early either end ended ending ends enough even evenly ever every everybody everyone
everything everywhere""".split()
)

# Cleaning of scraped HTML text (E11), applied in this order; a literal replace each.
HTML_TEXT_REPLACEMENTS = (
    ("’", "'"),
    ("‘", "'"),
    ('"', ""),
    ("|", ""),
    ("  ", ""),
    ("Explainer", ""),
    ("%E2%80%98", "'"),
    ("%E2%80%99", "'"),
    ("”", "'"),
    ("“", "'"),
    ("…", " "),
    ("-", " "),
)

# Contraction expansion (T1), applied in this order; literal, case-sensitive, not word-bounded.
CONTRACTIONS = (
    ("’", "'"),
    ("n't", " not "),
    ("'re", " are "),
    ("'s", " is "),
    ("'d", " would "),
    ("'ll", " will "),
    ("'t", " not "),
    ("'ve", " have "),
    ("'m", " am "),
)

# Link cleaning (E6): curly single quotes become "/'".
LINK_REPLACEMENTS = (("‘", "/'"), ("’", "/'"))

# Part-of-speech classes dropped by the tagger step.
DROPPED_POS = ("DET", "ADP", "CONJ", "PRON")
# Tags that take the noun-number step.
NOUN_TAGS = ("NN", "NE")

# Link rules.
LINK_KEEP_ANY = ("article", "comment", "news")
LINK_DROP_ANY = ("video",)
FALLBACK_LINK_DROP_ANY = ("photo", "app", "tel:", "video", "affiliate")

# Fuzzy date clean-up (E12): lower-case, then remove these substrings in order.
DATE_NOISE = ("(", ")", " published", " updated", "local")

# Sentiment dictionary categories.
SENTIMENT_CATEGORIES = ("negative", "positive", "uncertainty", "litigious", "constraining")

# Entity labels reported by N9, with their output column names.
ENTITY_COLUMNS = (("ORG", "company"), ("GPE", "country"), ("DATE", "date_event"), ("EVENT", "event"))

# Markers of the reading section and the metrics read from it (E14), in page order.
READING_START = r"Current condition and temperature\s*Hong Kong, Hong Kong"
READING_END = r"UV index: \d*\s*\w"
WEATHER_METRICS = ("Wind", "Humidity", "Precipitation", "Visibility", "UV index")

# ---------------------------------------------------------------------------
# Small demo lexicons (own values, not the analysed pipeline's models). Real
# runs pass a polarity / valence / gazetteer table instead.
# ---------------------------------------------------------------------------
DEMO_POLARITY = {
    "good": 0.7, "great": 0.8, "best": 1.0, "better": 0.5, "happy": 0.8, "safe": 0.5, "win": 0.8,
    "bad": -0.7, "worse": -0.4, "worst": -1.0, "sad": -0.5, "terrible": -1.0, "dangerous": -0.6,
    "fraud": -0.5, "loss": -0.3, "public": 0.0, "least": -0.3, "fast": 0.2,
}


# ---------------------------------------------------------------------------
# Accent folding table, built from a rule (Unicode decomposition), not typed in.
# ---------------------------------------------------------------------------
def _accent_table(lo: int = 0x00C0, hi: int = 0x024F) -> tuple[str, str]:
    src, dst = [], []
    for cp in range(lo, hi + 1):
        ch = chr(cp)
        decomposed = unicodedata.normalize("NFD", ch)
        base = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
        base = unicodedata.normalize("NFC", base)
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


ACCENTED, UNACCENTED = _accent_table()
