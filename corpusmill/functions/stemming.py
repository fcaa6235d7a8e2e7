"""Term keys: the sorted bag of stemmed lower-case words, so that word order and inflection do not matter.

The stemmer follows the published Porter2 (English Snowball) description in its regular steps. Keys are made once per distinct term.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate

VOWELS = "aeiouy"
# Fixed values of the published algorithm.
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("entli", "ent"), ("ization", "ize"), ("izer", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("aliti", "al"), ("alli", "al"), ("fulness", "ful"), ("ousli", "ous"), ("ousness", "ous"), ("iveness", "ive"), ("iviti", "ive"), ("biliti", "ble"), ("bli", "ble"), ("fulli", "ful"), ("lessli", "less"))
STEP3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic")


def _region(word: str, start: int) -> int:
    m = re.search(f"[{VOWELS}][^{VOWELS}]", word[start:])
    return start + m.end() if m else len(word)


def _short(word: str) -> bool:
    return bool(re.search(f"(^[{VOWELS}][^{VOWELS}]$)|([^{VOWELS}][{VOWELS}][^{VOWELS}wxY]$)", word))


def stem(word: str) -> str:
    if len(word) <= 2 or not word.isascii() or not word.isalpha():
        return word
    w = re.sub(f"(^y|(?<=[{VOWELS}])y)", "Y", word)
    r1 = next((len(p) for p in ("gener", "commun", "arsen") if w.startswith(p)), _region(w, 0))
    r2 = _region(w, r1)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(f"[{VOWELS}].", w[:-1]):
        w = w[:-1]
    for end in ("eedly", "eed"):
        if w.endswith(end):
            w = w[: -len(end)] + "ee" if len(w) - len(end) >= r1 else w
            break
    else:
        for end in ("ingly", "edly", "ing", "ed"):
            if w.endswith(end):
                if re.search(f"[{VOWELS}]", w[: -len(end)]):
                    w = w[: -len(end)]
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(DOUBLES):
                        w = w[:-1]
                    elif r1 >= len(w) and _short(w):
                        w += "e"
                break
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"
    for end, to in STEP2:
        if w.endswith(end):
            w = w[: -len(end)] + to if len(w) - len(end) >= r1 else w
            break
    else:
        if w.endswith("ogi") and len(w) - 3 >= r1 and w[-4:-3] == "l":
            w = w[:-1]
        elif w.endswith("li") and len(w) - 2 >= r1 and w[-3:-2] in tuple("cdeghkmnrt"):
            w = w[:-2]
    for end, to in STEP3:
        if w.endswith(end):
            w = w[: -len(end)] + to if len(w) - len(end) >= r1 else w
            break
    else:
        if w.endswith("ative") and len(w) - 5 >= r2:
            w = w[:-5]
    for end in STEP4:
        if w.endswith(end):
            w = w[: -len(end)] if len(w) - len(end) >= r2 else w
            break
    else:
        if w.endswith("ion") and len(w) - 3 >= r2 and w[-4:-3] in ("s", "t"):
            w = w[:-3]
    if w.endswith("e") and (len(w) - 1 >= r2 or len(w) - 1 >= r1 and not _short(w[:-1])):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()


@lru_cache(maxsize=200_000)
def stems(word: str) -> tuple[str, ...]:
    """Stems of the words in a token."""
    return tuple(stem(w) for w in re.findall(r"\w+", word.lower()))


def key_of(parts) -> str | None:
    """The key of the stems of several tokens; null where there is none."""
    return " ".join(sorted((s for p in parts for s in p), key=str.encode)) or None


def term_key(term: str | None) -> str | None:
    """Null where no word is left."""
    return key_of([stems(w) for w in (term or "").split()])


TOKEN = re.compile(r"\w+(?:[-']\w+)*|[^\w\s]")


PARTS = re.compile(f"({TOKEN.pattern})")


def token_places(text: str) -> tuple[list[str], list[int], list[int]]:
    """Tokens, their starts and their ends, as three lists."""
    parts = PARTS.split(text)
    ends = list(accumulate(map(len, parts)))
    return parts[1::2], ends[:-1:2], ends[1::2]


def tokenize(text: str) -> list[tuple[str, int, int]]:
    """Words (hyphens stay inside) and single punctuation marks, with their places."""
    return [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text or "")]
