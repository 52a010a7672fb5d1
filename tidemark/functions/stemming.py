"""English suffix stripping after Porter (1980), with the usual later extensions.

The rule tables are the published ones; the extensions (irregular forms, the
``ied``/``ies`` forms of short words, ``bli``, ``alli``, ``fulli`` and ``logi``)
are those commonly used with summary scoring.
"""

from __future__ import annotations

# Irregular forms.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing",
    "canning": "canning", "cannings": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Suffix tables of steps 2, 3 and 4.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
          "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """The word as a string of c (consonant) and v (vowel); y is a vowel after a consonant."""
    out = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    """Number of vowel-consonant sequences."""
    return _shape(word).count("vc")


def _has_vowel(word: str) -> bool:
    return "v" in _shape(word)


def _ends_double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _ends_cvc(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return len(word) > 2 and shape[-3:] == "cvc" and word[-1] not in "wxy"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix):
            base = word[:-len(suffix)]
            if not _has_vowel(base):
                return word
            if base.endswith(("at", "bl", "iz")):
                return base + "e"
            if _ends_double(base):
                return base if base[-1] in "lsz" else base[:-1]
            return base + "e" if _measure(base) == 1 and _ends_cvc(base) else base
    return word


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _replace(word: str, table: tuple[tuple[str, str], ...]) -> str:
    """The first suffix in the table that fits decides, whether or not its condition holds."""
    for suffix, new in table:
        if word.endswith(suffix):
            base = word[:-len(suffix)]
            return base + new if _measure(base) > 0 else word
    return word


def _step_2(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _step_2(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _replace(word, STEP_2)


def _step_4(word: str) -> str:
    for suffix in sorted(STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            base = word[:-len(suffix)]
            fits = _measure(base) > 1 and (suffix != "ion" or base[-1:] in ("s", "t"))
            return base if fits else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _ends_cvc(base)):
            word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past(_plural(word)))
    return _tidy(_step_4(_replace(_step_2(word), STEP_3)))
