"""Surrogates of people: one per person over titles, short forms and texts; against a version by plain dictionaries."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reviewloom.llm import pii

TEXTS = {
    1: "Mr John Smith came. Mr Smith left.",
    2: "Dr. John Smith wrote; Mr SMITH and John Smith read.",
    3: "Prof. John Smith again, with Mrs Smith and Mrs Jane Smith.",
    4: "Mr John Smith and Mr Tom Smith: Mr Smith.",
    5: "Frau Anna Schmidt met Mr Schmidt.", 6: "Dr Robin Field. Dr Field.", 7: "Mrs Robin Field.", 8: "Mr Robin Field.", 9: "Ms Robin Field.",
    10: "Herr Jan van der Berg, Herr Berg", 11: "nobody", 12: None, 13: "",
}


def rewritten(spark, texts, key="k"):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: r.text for r in pii.without_personal_data(docs, key).collect()}


@pytest.fixture(scope="module")
def out(spark):
    return rewritten(spark, TEXTS)


def test_one_person_has_one_surrogate(out):
    first, last = re.fullmatch(r"Mr (\w+) (\w+) came. Mr \2 left.", out[1]).groups()
    assert out[2] == f"Dr. {first} {last} wrote; Mr {last.upper()} and {first} {last} read."
    jane = re.fullmatch(rf"Prof. {first} {last} again, with Mrs (\w+) and Mrs (\w+) \1.", out[3])
    assert jane and jane[1] != last
    tom = re.fullmatch(rf"Mr {first} {last} and Mr (\w+) (\w+): Mr (\w+).", out[4])
    assert tom and tom[3] not in (last, tom[2])  # which of them is not told
    anna = re.fullmatch(r"Frau (\w+) (\w+) met Mr (\w+).", out[5])
    assert anna and anna[2] != anna[3]
    assert re.fullmatch(r"Herr \w+ \w+ \w+ (\w+), Herr \1", out[10])
    assert [out[i] for i in (11, 12, 13)] == ["nobody", None, ""]


def test_gender_of_a_person_is_chosen_once(out):
    name = out[7].removeprefix("Mrs ").rstrip(".")
    assert out[6] == f"Dr {name}. Dr {name.split()[1]}." and out[9] == f"Ms {name}."  # two texts say f, one says m
    assert out[8] != f"Mr {name}."


@pytest.mark.parametrize("text", [
    "token: http://x.com/a1", "secret=https://example.org/7/abc", "Version 1.2.3.4 and release: 2.0.0.19, BUILD v1.2.3.4",
    "commit d41d8cd98f00b204e9800998ecf8427e", "sha256 " + "0123456789abcdef" * 4,
])
def test_no_personal_data(text):
    assert pii.mentions(text) == []


def test_said_to_be_secret():
    text = "token=d41d8cd98f00b204e9800998ecf8427e at 1.2.3.4"
    assert [m[2] for m in pii.mentions(text)] == ["secret", "address"]


def test_many_people_have_names_of_two_words(spark):
    people = spark.range(20_000).select(F.lit("person").alias("kind"), F.concat(F.lit("m:a"), F.col("id").cast("string"), F.lit(" b")).alias("norm"))
    got = [r.surrogate[2:] for r in pii.surrogates(people, b"k").collect()]
    assert len(set(got)) == 20_000 and all(re.fullmatch(r"[a-z]+ [a-z]{4,16}", n) for n in got)


def test_every_text_with_a_mention_is_searched(spark, sf):
    extra = ["sk-" + "a1" * 12, "x ghp_" + "A1" * 18, "a@b.co", "api_key = abc1234", "password:\x1c'abc123'", "+٤٩ 30 1234567", "(555) 123-4567",
             "4111111111111111", "3782 822463 10005", "DE89370400440532013000", "Госпожа Иванова", "ΚύριοςΚ", "Señora Díaz", "zSir Tom", "é1.2.3.4", *filter(None, TEXTS.values())]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text").unionByName(spark.createDataFrame([(t,) for t in extra], "text string"))
    rows = docs.select("text", pii.may_mention(F.col("text")).alias("may")).collect()
    assert all(r.may for r in rows if r.text and pii.mentions(r.text))
    assert sum(r.may for r in rows) < len(rows) / 2


def by_dictionaries(texts, key):
    """The rewritten texts with all entities, genders and draws in plain dictionaries."""
    found = {i: pii.mentions(t or "") for i, t in texts.items()}
    held_by = Counter((k, n) for ms in found.values() for k, n in {m[2:] for m in ms})
    genders = defaultdict(dict)
    for (kind, norm), n in held_by.items():
        if kind == "person" and norm[0] != "n":
            genders[norm[2:]][norm[0]] = n

    def entity(kind, norm):
        told = genders[norm[2:]] if kind == "person" and norm[0] == "n" else None
        return (kind, f"{max(told, key=lambda g: (told[g], g == 'f'))}:{norm[2:]}") if told else (kind, norm)

    shown = lambda kind, x: (kind, x[2:] if kind == "person" else x)
    real = {shown(k, n) for k, n in {entity(*e) for e in held_by}}
    attempts, settled = dict.fromkeys({entity(*e) for e in held_by}, 0), {}
    while attempts:
        drawn = {e: pii.DETECTORS[e[0]].surrogate(e[1], key.encode(), a) for e, a in attempts.items()}
        held = {shown(k, s) for (k, _), s in settled.items()}
        for e in sorted(drawn):
            place = shown(e[0], drawn[e])
            if place not in real and place not in held and e == min(o for o in drawn if shown(o[0], drawn[o]) == place):
                settled[e] = drawn[e]
        attempts = {e: a + 1 for e, a in attempts.items() if e not in settled}
    out = {}
    for i, t in texts.items():
        for a, b, kind, norm in reversed(found[i]):
            t = t[:a] + pii.laid_out(kind, t[a:b], settled[entity(kind, norm)]) + t[b:]
        out[i] = t
    return out, settled


def test_texts_as_by_dictionaries(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    crowd = {10**9 + i: t for i, t in TEXTS.items()} | {2 * 10**9 + i: f"ssn 123-4{i % 10}-67{i:02}, Mr A{'bcdefghij'[i % 9]} Young and Mrs Xu" for i in range(90)}
    docs = docs.unionByName(spark.createDataFrame(list(crowd.items()), "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    want, settled = by_dictionaries(texts, "k")
    assert {r.doc_id: r.text for r in pii.without_personal_data(docs, "k").collect()} == want
    assert len(settled) > 120 and len({(k, s[2:] if k == "person" else s) for (k, _), s in settled.items()}) == len(settled)
