"""The first English stemmer (Porter 1980) as SQL expressions over a table of distinct words.

As in `stemming`, each step is a column of SQL text that Spark and DuckDB both run. The conditions of the rules speak of the
measure of a stem, the number of its vowel-consonant groups; m > 0 and m > 1 are tested as patterns. A consonant y is written Y
while the rules run.

`extended` adds the later rules of the toolkits that TF-IDF users have: a few whole words, -ies and -ied of short words,
-y after a consonant only, -alli before the other rules of step 2, -bli, -fulli and -logi, and words of two letters stay.
"""

from __future__ import annotations

from collections.abc import Mapping

from reviewloom.functions.stemming import _ends, _head, _longest, _text

# Suffix tables of the published definition
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous",
         "ive", "ize"]
# Words and suffixes of the extended form
WHOLE = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning",
    "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
MORE2 = {"bli": "ble", "fulli": "ful"}

_GROUP = "[aeiouy][^aeiouy]"
_TWO_GROUPS = "[aeiouy][^aeiouy]+[aeiouy]+[^aeiouy]"
_CVC = "[^aeiouy][aeiouy][^aeiouywxY]$"


def porter_steps(word: str, dialect: str = "spark", extended: bool = True) -> list[tuple[str, str]]:
    """(column, SQL) from the lower-case column `word` to `_stem`; every step may use the columns before it."""
    def has(text: str, pattern: str) -> str:
        return {"spark": f"({text} RLIKE '{pattern}')", "duckdb": f"regexp_matches({text}, '{pattern}')"}[dialect]

    def cvc(text: str) -> str:
        return has(text, f"({_CVC}|^[aeiouy][^aeiouy]$)" if extended else _CVC)

    def rules(w: str, pairs: Mapping[str, str], measure: str) -> dict[str, str]:
        return {
            s: f"CASE WHEN {has(_head(w, len(s)), measure)} THEN {_head(w, len(s))} || {_text(new)} ELSE {w} END"
            for s, new in pairs.items()
        }

    found: list[tuple[str, str]] = []

    def step(name: str, sql: str) -> str:
        found.append((name, sql))
        return name

    first = step("_y0", f"CASE WHEN substr({word}, 1, 1) = 'y' THEN 'Y' || substr({word}, 2) ELSE {word} END")
    to = {"spark": "'$1Y'", "duckdb": "'\\1Y', 'g'"}[dialect]
    w = step("_y1", f"regexp_replace({first}, '([aeiouy])y', {to})")

    ies = _head(w, 2)
    if extended:
        ies = f"CASE WHEN length({w}) = 4 THEN {_head(w, 1)} ELSE {ies} END"
    w = step("_s1a", _longest(w, {"sses": _head(w, 2), "ies": ies, "ss": w, "s": _head(w, 1)}))

    def past(n: int) -> str:
        h = _head(w, n)
        at = " OR ".join(_ends(h, e) for e in ("at", "bl", "iz"))
        twice = (f"(length({h}) > 1 AND right({h}, 1) = substr({h}, length({h}) - 1, 1) AND NOT {has(h, '[aeiouylsz]$')} "
                 f"OR right({h}, 2) = 'yY')")
        short = f"{has(h, _GROUP)} AND NOT {has(h, _TWO_GROUPS)} AND {cvc(h)}"
        return (f"CASE WHEN NOT {has(h, '[aeiouy]')} THEN {w} WHEN {at} THEN {h} || 'e' WHEN {twice} THEN {_head(w, n + 1)} "
                f"WHEN {short} THEN {h} || 'e' ELSE {h} END")

    tails = rules(w, {"eed": "ee"}, _GROUP) | {"ed": past(2), "ing": past(3)}
    if extended:
        tails["ied"] = f"CASE WHEN length({w}) = 4 THEN {_head(w, 1)} ELSE {_head(w, 2)} END"
    w = step("_s1b", _longest(w, tails))

    h = _head(w, 1)
    turns = f"length({h}) > 1 AND {has(h, '[^aeiouy]$')}" if extended else has(h, "[aeiouy]")
    w = step("_s1c", f"CASE WHEN right({w}, 1) IN ('y', 'Y') AND {turns} THEN {h} || 'i' ELSE {w} END")

    pairs = dict(STEP2)
    if extended:
        w = step("_s2a", f"CASE WHEN {_ends(w, 'alli')} AND {has(_head(w, 4), _GROUP)} THEN {_head(w, 2)} ELSE {w} END")
        pairs = {s: new for s, new in pairs.items() if s != "abli"} | MORE2
    tails = rules(w, pairs, _GROUP)
    if extended:
        tails["logi"] = f"CASE WHEN {has(_head(w, 3), _GROUP)} THEN {_head(w, 1)} ELSE {w} END"
    w = step("_s2", _longest(w, tails))
    w = step("_s3", _longest(w, rules(w, STEP3, _GROUP)))
    tails = rules(w, {s: "" for s in STEP4}, _TWO_GROUPS)
    tails["ion"] = (f"CASE WHEN {has(_head(w, 3), _TWO_GROUPS)} AND {has(_head(w, 3), '[st]$')} THEN {_head(w, 3)} "
                    f"ELSE {w} END")
    w = step("_s4", _longest(w, tails))
    h = _head(w, 1)
    silent = f"{has(h, _TWO_GROUPS)} OR ({has(h, _GROUP)} AND NOT {cvc(h)})"
    w = step("_s5a", f"CASE WHEN {_ends(w, 'e')} AND ({silent}) THEN {h} ELSE {w} END")
    w = step("_s5b", f"CASE WHEN {_ends(w, 'll')} AND {has(_head(w, 1), _TWO_GROUPS)} THEN {_head(w, 1)} ELSE {w} END")
    plain = f"replace({w}, 'Y', 'y')"
    if extended:
        whole = " ".join(f"WHEN {word} = {_text(k)} THEN {_text(v)}" for k, v in WHOLE.items())
        plain = f"CASE WHEN length({word}) <= 2 THEN {word} {whole} ELSE {plain} END"
    step("_stem", plain)
    return found
