"""Plain-Python statements of the text rules, used as brute-force oracles on fixtures."""

import re

from dailywire.functions import lexicons as L


def contractions(s: str) -> str:
    for a, b in L.CONTRACTIONS:
        s = s.replace(a, b)
    return s


# characters that become a blank in the punctuation / digit / slash steps
_BLANKED = set("()‘’“”…+-{}\\.;!,?'\"/\n")


def special(s: str) -> str:
    """T2 as a character translation: after the single-letter rule and a strip, every listed
    punctuation mark, digit, slash, bracket and newline is a blank, '&' reads ' and ', and blank
    runs collapse to one blank (a leading / trailing blank may stay)."""
    s = re.sub(r"(?:^| )\w(?:$| )", " ", s).strip()
    out = []
    for ch in s:
        if ch in _BLANKED or ch.isdecimal():
            out.append(" ")
        elif ch == "&":
            out.append(" and ")
        else:
            out.append(ch)
    return re.sub(r"\s+", " ", "".join(out))


def stopwords(s: str, words, lower=True) -> str:
    base = s.lower() if lower else s
    kept = [t for t in base.split(" ") if t not in set(words)]
    new = " ".join(kept)
    return new if len(new) > 5 else s


def html_text(s: str) -> str:
    for a, b in L.HTML_TEXT_REPLACEMENTS:
        s = s.replace(a, b)
    return s.strip()


def keyterm(s: str, terms) -> int | None:
    return 1 if any(t in terms for t in s.split(" ")) else None


def shared_letters(a: str, b: str) -> int:
    from collections import Counter

    return sum((Counter(a) & Counter(b)).values())
