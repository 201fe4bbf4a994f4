"""Porter's stemmer (1980) as an ordered table of suffix rules, applied by built-in functions to the distinct words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions.text import bound

# Conditions on what stands before a suffix, as patterns over its shape: a word with v for each vowel and c for each
# consonant. The measure m is the number of times vc occurs with runs taken as one.
ANY, VOWEL, M_OVER_0, M_OVER_1 = "%", "%v%", "%vc%", "%vc%vc%"

#: The steps of the published algorithm in order. Of the suffixes that a word ends in the first counts, whether or not its
#: condition holds: (suffix, replacement, condition). Fixed values.
PLURALS = (("sses", "ss", ANY), ("ies", "i", ANY), ("ss", "ss", ANY), ("s", "", ANY))
PAST = (("eed", "ee", M_OVER_0), ("ed", "", VOWEL), ("ing", "", VOWEL))
FINAL_Y = (("y", "i", VOWEL),)
DOUBLE_SUFFIXES = tuple((suffix, new, M_OVER_0) for suffix, new in (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
))
ADJECTIVES = tuple((suffix, new, M_OVER_0) for suffix, new in (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
))
#: The longer of two endings stands first; "ion" goes only after s or t.
BARE = tuple((suffix, "", M_OVER_1) for suffix in (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ion", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic", "ou",
))
#: After "ed" or "ing" went.
REPAIRED = ("at", "bl", "iz")


_LETTERS = "aeioubcdfghjklmnpqrstvwxz"
_MARKS = "".join("v" if c in "aeiou" else "c" for c in _LETTERS)


def shape(word: Column) -> Column:
    """The word as a string of v and c; y is a vowel after a consonant."""
    marked = F.translate(word, _LETTERS, _MARKS)
    marked = F.when(F.regexp_like(marked, F.lit("[^vcy]")), F.regexp_replace(marked, "[^vcy]", "c")).otherwise(marked)
    turn = lambda s: F.replace(F.replace(s, F.lit("cy"), F.lit("cv")), F.lit("vy"), F.lit("vc"))
    # Each turn settles two letters of a run of y.
    rounds = lambda s: F.sequence(F.lit(1), F.length(s))
    started = lambda s: F.when(F.startswith(s, F.lit("y")), F.concat(F.lit("c"), F.substr(s, F.lit(2)))).otherwise(s)
    return bound(marked, lambda m: F.when(F.contains(m, F.lit("y")), F.aggregate(rounds(m), started(m), lambda s, _: turn(s))).otherwise(m))


def _before(word: Column, suffix: str) -> Column:
    return F.left(word, F.length(word) - len(suffix))


def _short_end(stem: Column, its_shape: Column) -> Column:
    return F.endswith(its_shape, F.lit("cvc")) & ~F.right(stem, F.lit(1)).isin("w", "x", "y")


def _rules(rules, word: Column) -> Column:
    """The first rule whose suffix the word has. Only then the shape before it is looked at."""
    out = None
    for suffix, new, condition in rules:
        stem = _before(word, suffix)
        value = F.concat(stem, F.lit(new))
        if condition != ANY:
            kept = shape(stem).like(condition)
            if rules is BARE and suffix == "ion":
                kept = F.right(stem, F.lit(1)).isin("s", "t") & kept
            value = F.when(kept, value).otherwise(word)
        has = F.endswith(word, F.lit(suffix))
        out = F.when(has, value) if out is None else out.when(has, value)
    return out.otherwise(word)


def _repaired(stem: Column, form: Column) -> Column:
    """A stem that lost "ed" or "ing"."""
    ends = reduce(lambda a, b: a | b, [F.endswith(stem, F.lit(x)) for x in REPAIRED])
    last = F.right(stem, F.lit(1))
    doubled = (F.length(stem) > 1) & (last == F.substr(stem, F.length(stem) - 1, F.lit(1))) & F.endswith(form, F.lit("c")) & ~last.isin("l", "s", "z")
    once = form.like(M_OVER_0) & ~form.like(M_OVER_1)
    return F.when(ends, F.concat(stem, F.lit("e"))).when(doubled, _before(stem, "x")).when(
        once & _short_end(stem, form), F.concat(stem, F.lit("e"))
    ).otherwise(stem)


def _past(word: Column) -> Column:
    def cut(suffix: str) -> Column:
        stem = _before(word, suffix)
        return F.when(shape(stem).like(VOWEL), bound(stem, lambda w: bound(shape(w), lambda s: _repaired(w, s)))).otherwise(word)

    eed, ed, ing = PAST
    return F.when(F.endswith(word, F.lit(eed[0])), _rules((eed,), word)).when(F.endswith(word, F.lit(ed[0])), cut(ed[0])).when(
        F.endswith(word, F.lit(ing[0])), cut(ing[0])
    ).otherwise(word)


def _final_e(word: Column) -> Column:
    stem = _before(word, "e")
    goes = bound(shape(stem), lambda s: s.like(M_OVER_1) | (s.like(M_OVER_0) & ~_short_end(stem, s)))
    return F.when(F.endswith(word, F.lit("e")), F.when(goes, stem).otherwise(word)).otherwise(word)


def _final_l(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("ll")) & shape(word).like(M_OVER_1), _before(word, "l")).otherwise(word)


def porter_stem(word: Column) -> Column:
    """Stem of a lower-case word; words of one or two letters stay, NULL stays NULL."""
    by_rules = lambda rules: lambda w: _rules(rules, w)
    steps = (by_rules(PLURALS), _past, by_rules(FINAL_Y), by_rules(DOUBLE_SUFFIXES), by_rules(ADJECTIVES), by_rules(BARE), _final_e, _final_l)
    return F.when(F.length(word) < 3, word).otherwise(reduce(bound, steps, word))
