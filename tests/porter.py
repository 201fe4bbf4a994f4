"""Porter's stemmer (1980) word by word, as the brute-force version of the rules in SQL."""

from __future__ import annotations

import re

# Suffix rules of steps 2, 3 and 4 of the published algorithm.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """The word as a string of v and c; y is a vowel after a consonant."""
    out = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out[-1:] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(stem: str) -> bool:
    return _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plurals(w: str) -> str:
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suffix):
            return w[: len(w) - len(suffix)] + new
    return w


def _past(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    suffix = _longest(w, ("ed", "ing"))
    if suffix is None or "v" not in _shape(w[: -len(suffix)]):
        return w
    w = w[: -len(suffix)]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if len(w) > 1 and w[-1] == w[-2] and _shape(w)[-1] == "c" and w[-1] not in "lsz":
        return w[:-1]
    return w + "e" if _measure(w) == 1 and _short_end(w) else w


def _mapped(w: str, rules: dict[str, str]) -> str:
    suffix = _longest(w, rules)
    if suffix is not None and _measure(w[: -len(suffix)]) > 0:
        return w[: -len(suffix)] + rules[suffix]
    return w


def _bare(w: str) -> str:
    suffix = _longest(w, STEP4)
    if suffix is None:
        return w
    stem = w[: -len(suffix)]
    if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
        return stem
    return w


def porter(word: str) -> str:
    if len(word) < 3:
        return word
    w = _past(_plurals(word))
    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    w = _bare(_mapped(_mapped(w, STEP2), STEP3))
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w
