"""The first Porter stemmer: published words, a letter-by-letter version, and both engines."""

import re

import duckdb
import pytest

from reviewloom.functions.porter import STEP2, STEP3, STEP4, WHOLE, porter_steps
from reviewloom.functions.stemming import stemmed_sql
from reviewloom.operators import corpus as T

# Words of the published definition with their whole stems
PUBLISHED = dict(pair.split(":") for pair in """
caresses:caress ponies:poni caress:caress cats:cat feed:feed agreed:agre plastered:plaster bled:bled motoring:motor
sing:sing conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall hissing:hiss fizzed:fizz
failing:fail filing:file happy:happi relational:relat conditional:condit rational:ration valenci:valenc
hesitanci:hesit digitizer:digit conformabli:conform radicalli:radic differentli:differ vileli:vile analogousli:analog
vietnamization:vietnam predication:predic operator:oper feudalism:feudal decisiveness:decis hopefulness:hope
callousness:callous formaliti:formal sensitiviti:sensit sensibiliti:sensibl triplicate:triplic formative:form
formalize:formal electriciti:electr electrical:electr hopeful:hope goodness:good revival:reviv allowance:allow
inference:infer airliner:airlin gyroscopic:gyroscop adjustable:adjust defensible:defens irritant:irrit
replacement:replac adjustment:adjust dependent:depend adoption:adopt homologou:homolog communism:commun
activate:activ angulariti:angular homologous:homolog effective:effect bowdlerize:bowdler probate:probat rate:rate
cease:ceas controll:control roll:roll generalizations:gener oscillators:oscil
""".split())
EXTENDED = WHOLE | {
    "dies": "die", "ties": "tie", "tied": "tie", "flies": "fli", "cried": "cri", "say": "say", "enjoy": "enjoy", "by": "by", "is": "is",
    "geology": "geolog", "apology": "apolog", "probably": "probabl", "carefully": "care", "syzygy": "syzygi",
}


def consonants(word):
    """True per letter that is a consonant: y is one at the start and after a vowel."""
    out = []
    for i, c in enumerate(word):
        out.append(c not in "aeiou" if c != "y" else i == 0 or not out[-1])
    return out


def measure(stem):
    return len(re.findall("v+c+", "".join("c" if c else "v" for c in consonants(stem))))


def by_letters(word, extended):
    """The same rules read off the definition, one word at a time."""
    if extended and (word in WHOLE or len(word) <= 2):
        return WHOLE.get(word, word)

    def cvc(w):
        k = consonants(w)
        return (len(w) > 2 and k[-3:] == [True, False, True] and w[-1] not in "wxy") or (extended and k == [False, True])

    def swap(w, table, least):
        for s in sorted(table, key=len, reverse=True):
            if w.endswith(s):
                stem = w[:len(w) - len(s)]
                return stem + table[s] if measure(stem) > least else w
        return w

    w = word
    if w.endswith("ies"):
        w = w[:-1] if extended and len(w) == 4 else w[:-2]
    elif w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    tail = next((t for t in ("eed", "ied", "ing", "ed") if w.endswith(t) and (extended or t != "ied")), None)
    if tail == "eed":
        w = w[:-1] if measure(w[:-3]) else w
    elif tail == "ied":
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif tail and not all(consonants(w[:-len(tail)])):
        w = w[:-len(tail)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif len(w) > 1 and w[-1] == w[-2] and consonants(w)[-1] and w[-1] not in "lsz":
            w = w[:-1]
        elif measure(w) == 1 and cvc(w):
            w += "e"
    if w.endswith("y"):
        k = consonants(w[:-1])
        if (len(k) > 1 and k[-1]) if extended else not all(k):
            w = w[:-1] + "i"
    two = dict(STEP2)
    if extended:
        del two["abli"]
        two |= {"bli": "ble", "fulli": "ful"}
        if w.endswith("alli") and measure(w[:-4]):
            w = w[:-2]
    if extended and w.endswith("logi"):
        w = w[:-1] if measure(w[:-3]) else w
    else:
        w = swap(w, two, 0)
    w = swap(w, STEP3, 0)
    four = {s: "" for s in STEP4}
    if w.endswith("ion"):
        w = w[:-3] if measure(w[:-3]) > 1 and w[:-3][-1:] in ("s", "t") else w
    else:
        w = swap(w, four, 1)
    if w.endswith("e") and (measure(w[:-1]) > 1 or measure(w[:-1]) == 1 and not cvc(w[:-1])):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and measure(w[:-1]) > 1 else w


def spark_stems(spark, words, extended):
    table = spark.createDataFrame([(w,) for w in words], "word string")
    rules = lambda word, dialect="spark": porter_steps(word, dialect, extended)
    return {r.word: r.stem for r in T.word_stems(table, "word", rules=rules).collect()}


def test_published_words(spark):
    assert spark_stems(spark, PUBLISHED, False) == PUBLISHED


def test_extended_words(spark):
    assert spark_stems(spark, EXTENDED, True) == EXTENDED


@pytest.mark.parametrize("extended", [True, False])
def test_as_letter_by_letter(spark, sf, extended):
    texts = duckdb.sql(f"SELECT lower(text) FROM '{sf}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    words = {w for (t,) in texts for w in re.findall(r"[a-z0-9']+", t)}
    ends = "s sses ies ss eed ed ing ied y yed yying logi alli ll e ion tion sion ement".split() + list(STEP2) + list(STEP3) + STEP4
    heads = "a by cry tr ab fall hopp oper sayy eat yoy box snow abil crea tall mult 7 00 été gener u".split()
    words |= {h + e for h in heads for e in ends} | {h + e + "s" for h in heads for e in ends} | {"", "y", "yyy", "yyyy", "sayyed"}
    got = spark_stems(spark, words, extended)
    assert got == {w: by_letters(w, extended) for w in words}
    con = duckdb.connect()
    con.execute("CREATE TABLE words AS SELECT unnest($1) AS word", [sorted(words)])
    rules = lambda word, dialect: porter_steps(word, dialect, extended)
    assert dict(con.execute(f"SELECT word, _stem FROM {stemmed_sql('words', 'word', rules)}").fetchall()) == got


def test_other_stop_list(spark):
    texts = spark.createDataFrame([("a", "Hoping, hopes! cats"), ("b", "cats dying")], "file_name string, text string")
    rows = T.stemmed_tfidf(texts, words=["hope"], rules=porter_steps).collect()
    assert {(r.file_name, r.term) for r in rows} == {("a", "cat"), ("b", "cat"), ("b", "die")}
