"""English stemming (Porter2) as SQL expressions over a table of distinct words.

The rules are CASE expressions in SQL text that Spark and DuckDB both run; `steps` names one column per step, each
from the one before. No Python runs per word, and each distinct word is stemmed once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

#: (word column, dialect) to the columns of a stemmer, the last being _stem
Rules = Callable[..., list[tuple[str, str]]]

# Suffix tables and exceptions of the published Porter2 (Snowball English) definition
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
    "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
KEPT = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize",
    "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al",
    "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive",
    "biliti": "ble", "bli": "ble", "fulli": "ful", "lessli": "less",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate",
         "iti", "ous", "ive", "ize"]

_REGION = "'(?s)^.*?[aeiouy][^aeiouy]'"
_SHORT = "((?s)^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _head(word: str, cut: int | str) -> str:
    """The word without its last `cut` letters."""
    return f"substr({word}, 1, greatest(length({word}) - {cut}, 0))"


def _ends(word: str, suffix: str) -> str:
    return f"(right({word}, {len(suffix)}) = {_text(suffix)} AND length({word}) >= {len(suffix)})"


def _longest(word: str, results: Mapping[str, str]) -> str:
    """CASE over suffixes, longest first; `results` has the SQL for each. Other words stay."""
    cases = " ".join(f"WHEN {_ends(word, s)} THEN {results[s]}" for s in sorted(results, key=lambda s: (-len(s), s)))
    return f"CASE {cases} ELSE {word} END"


def _replaced(word: str, region: str, pairs: Iterable[tuple[str, str]]) -> dict[str, str]:
    """suffix to SQL: replaced where the suffix lies in the region, else the word as it is."""
    return {
        s: f"CASE WHEN length({word}) - {len(s)} >= {region} THEN {_head(word, len(s))} || {_text(new)} ELSE {word} END"
        for s, new in pairs
    }


def steps(word: str, dialect: str = "spark") -> list[tuple[str, str]]:
    """(column, SQL) from the column `word` to `_stem`; every step may use the columns before it."""
    def sub(text: str, pattern: str, to: str) -> str:
        back = {"spark": f"'$1{to}'", "duckdb": f"'\\1{to}', 'g'"}[dialect]
        return f"regexp_replace({text}, '{pattern}', {back})"

    def has(text: str, pattern: str) -> str:
        return {"spark": f"({text} RLIKE '{pattern}')", "duckdb": f"regexp_matches({text}, '{pattern}')"}[dialect]

    vowel = lambda text: has(text, "[aeiouy]")
    found: list[tuple[str, str]] = []

    def step(name: str, sql: str) -> str:
        found.append((name, sql))
        return name

    bare = step("_bare", f"TRIM(LEADING '''' FROM {word})")
    first = step("_y0", f"CASE WHEN substr({bare}, 1, 1) = 'y' THEN 'Y' || substr({bare}, 2) ELSE {bare} END")
    once = step("_y1", sub(first, "([aeiouy])y", "Y"))
    w = step("_y2", sub(once, "([aeiouyY])y", "Y"))
    match = step("_m1", f"regexp_extract({w}, {_REGION}, 0)")
    heads = " ".join(f"WHEN substr({w}, 1, {len(h)}) = '{h}' THEN {len(h)}" for h in ("gener", "commun", "arsen"))
    step("_r1", f"CASE {heads} WHEN {match} = '' THEN length({w}) ELSE length({match}) END")
    match = step("_m2", f"regexp_extract(substr({w}, _r1 + 1), {_REGION}, 0)")
    step("_r2", f"CASE WHEN {match} = '' THEN length({w}) ELSE _r1 + length({match}) END")

    w = step("_s0", _longest(w, {s: _head(w, len(s)) for s in ("'s'", "'s", "'")}))
    ies = f"CASE WHEN length({w}) > 4 THEN {_head(w, 2)} ELSE {_head(w, 1)} END"
    plain = f"CASE WHEN {vowel(_head(w, 2))} THEN {_head(w, 1)} ELSE {w} END"
    w = step("_s1a", _longest(w, {"sses": _head(w, 2), "ied": ies, "ies": ies, "us": w, "ss": w, "s": plain}))
    step("_kept", f"{w} IN ({', '.join(map(_text, KEPT))})")

    def past(n: int) -> str:
        h = _head(w, n)
        double = " OR ".join(_ends(h, c * 2) for c in "bdfgmnprt")
        more = " OR ".join(_ends(h, e) for e in ("at", "bl", "iz"))
        return (f"CASE WHEN NOT {vowel(h)} THEN {w} WHEN {more} THEN {h} || 'e' WHEN {double} THEN {_head(w, n + 1)} "
                f"WHEN _r1 >= length({h}) AND {has(h, _SHORT)} THEN {h} || 'e' ELSE {h} END")

    rules = _replaced(w, "_r1", [("eed", "ee"), ("eedly", "ee")]) | {s: past(len(s)) for s in ("ed", "edly", "ing", "ingly")}
    w = step("_s1b", _longest(w, rules))
    w = step("_s1c", f"CASE WHEN length({w}) > 2 AND right({w}, 1) IN ('y', 'Y') AND NOT {vowel(f'substr({w}, length({w}) - 1, 1)')} "
                     f"THEN {_head(w, 1)} || 'i' ELSE {w} END")
    rules = _replaced(w, "_r1", STEP2.items())
    rules["ogi"] = f"CASE WHEN length({w}) - 3 >= _r1 AND {_ends(_head(w, 3), 'l')} THEN {_head(w, 1)} ELSE {w} END"
    rules["li"] = f"CASE WHEN length({w}) - 2 >= _r1 AND {has(_head(w, 2), '[cdeghkmnrt]$')} THEN {_head(w, 2)} ELSE {w} END"
    w = step("_s2", _longest(w, rules))
    rules = _replaced(w, "_r1", STEP3.items())
    rules["ative"] = f"CASE WHEN length({w}) - 5 >= _r2 AND length({w}) - 5 >= _r1 THEN {_head(w, 5)} ELSE {w} END"
    w = step("_s3", _longest(w, rules))
    rules = _replaced(w, "_r2", [(s, "") for s in STEP4])
    rules["ion"] = f"CASE WHEN length({w}) - 3 >= _r2 AND {has(_head(w, 3), '[st]$')} THEN {_head(w, 3)} ELSE {w} END"
    w = step("_s4", _longest(w, rules))
    silent = (f"CASE WHEN length({w}) - 1 >= _r2 OR (length({w}) - 1 >= _r1 AND NOT {has(_head(w, 1), _SHORT)}) "
              f"THEN {_head(w, 1)} ELSE {w} END")
    w = step("_s5", _longest(w, {"e": silent, "ll": f"CASE WHEN length({w}) - 1 >= _r2 THEN {_head(w, 1)} ELSE {w} END"}))
    special = " ".join(f"WHEN {bare} = {_text(k)} THEN {_text(v)}" for k, v in SPECIAL.items())
    step("_stem", f"CASE WHEN length({word}) <= 2 THEN {word} {special} WHEN _kept THEN _s1a ELSE replace({w}, 'Y', 'y') END")
    return found


def stemmed_sql(words: str, word: str, rules: Rules = steps) -> str:
    """DuckDB: a query that adds `_stem` to the rows of the query or table `words`."""
    out = f"(SELECT *, {word} AS _word FROM {words})"
    for name, sql in rules("_word", "duckdb"):
        out = f"(SELECT *, {sql} AS {name} FROM {out})"
    return out
