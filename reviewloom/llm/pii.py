"""Surrogates for personal data: the same entity has the same replacement everywhere, two entities never share one.

Method. Detectors find mentions; a mention's entity is its kind and normal form (digits of a phone or card,
lower-cased mail address, ...). Each distinct entity of the corpus gets a surrogate from a keyed hash (BLAKE2 with a
secret key, entity and number of the attempt): digits become digits, letters become letters of the same script and
case, card numbers keep their issuer digit and get a right check digit, addresses stay valid, key prefixes and
top-level domains stay, names come from lists of the same gender and script. Spark then checks collisions: a surrogate
that is a real entity of the corpus, that another entity holds already, or that several ask for (the first in order
gets it) is drawn again. Only then are the texts written: a mention's surrogate takes the layout of the mention
(separators, capitals), so coreference survives within and across documents. A name is any number of capitalised parts
(with hyphens, apostrophes, initials and the small words of INSIDE) behind a title; the same full name without a title is
found in the texts where it stands with one, and a titled last name ("Mr Smith") is the one full name of the text that
ends in it, if there is just one that its title names too or else doesn't contradict. A person is a name and a gender: "Dr. John Smith" is the
"Mr John Smith" of other texts, "Mrs Smith" is not "Mr Smith". Last names are put together of syllables, as many as it takes.

Spark's own pattern matching lets pass most texts without any mention; the others are searched once, in Python, and
written with what was found. Only documents with mentions meet the table of surrogates (by joins on entities and rows); all others pass
as they are and are not shuffled.

Defined results: null texts stay null and texts without mentions stay as they are; overlapping mentions go to the kind
that stands first in DETECTORS; rows that repeat an id are rewritten each; empty tables give empty results; other
columns pass unchanged, whatever their names. Texts are read and written whole. Draws go on until every entity has its
own; from the LONGER-th attempt on surrogates get longer, so there is always a free one.

The key is a parameter and must be kept secret; with the same key and corpus results repeat.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from reviewloom.llm.shipping import small_batches
from reviewloom.session import cut_lineage

LONGER = 6

#: Titles, and common first and last names by script and gender
TITLES = {
    "Mr": "m", "Mister": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
    "Sir": "m", "Hr": "m", "Sr": "m", "Sra": "f", "Srta": "f", "Señorita": "f", "Doña": "f", "Mlle": "f", "Mademoiselle": "f",
    "Dr": "n", "Doctor": "n", "Doktor": "n", "Doctora": "f", "Dra": "f", "Docteur": "n", "Prof": "n", "Professor": "n",
    "Professorin": "f", "Profesor": "m", "Profesora": "f", "Professeur": "n", "Доктор": "n", "Профессор": "n", "Καθηγητής": "m",
    "Καθηγήτρια": "f",
}
#: small words that stand inside names
INSIDE = "von van der den de del della di da dos du la le ten ter zu bin ibn al el"
FIRST = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Noah Oscar Paul Robert Simon Tom Victor",
    ("latin", "f"): "Alice Bella Clara Diana Emma Flora Gina Helen Irene Julia Klara Laura Maria Nora Olga Paula Rosa Sofia Tina Vera",
    ("cyrillic", "m"): "Алексей Борис Виктор Денис Егор Иван Константин Лев Максим Никита Олег Павел Роман Сергей Тимур",
    ("cyrillic", "f"): "Алла Белла Вера Галина Дарья Елена Жанна Ирина Лариса Мария Нина Ольга Полина Софья Татьяна",
    ("greek", "m"): "Αλέξης Βασίλης Γιάννης Δημήτρης Κώστας Λευτέρης Μιχάλης Νίκος Πέτρος Σταύρος",
    ("greek", "f"): "Αγγελική Βάσω Γεωργία Δήμητρα Ελένη Ζωή Κατερίνα Λένα Μαρία Νίκη",
}
#: last names are put together of a first, any number of inner and a last syllable
LAST = {
    "latin": ("Ba Be Bo Bra Car Dal Del Fa Fer Gar Hal Han Kel Lan Mar Mor Nel Or Par Per Ran Ros Sal Sten Tal Tor Val Ver Wal Win",
              "ba da den do fe ga la le lin lo ma men mo na ne ri ro sa ta ven",
              "berg by der dal feld ford gard holm ler land ley man mar ner rin sen son stad ter ton vik wood"),
    "cyrillic": ("Ба Бе Бо Ва Ве Во Га Го Да До Жу За Зо Ка Ко Ла Ли Ма Ми Мо На Ни Ор Па Пе Ро Са Си Та Фо",
                 "ба ва га да ла ле ли ло ма ме ми на но ра ре ри са та ти ту", "денко ренко тенко ленко менко сюк люк нюк ник вич рич дзе швили ян нян лан рон"),
    "greek": ("Βα Βε Γα Γε Δα Δη Ζα Θε Κα Κο Λα Λε Μα Με Μι Να Νι Πα Πε Ρα Ρο Σα Σι Στα Τα Τσι Φα Φι Χα Χρι",
              "βα γα δα κα κο λα λε λι μα με μι να νο πα ρα ρι ρο σα τα τι", "δου κου λου μου νου ρου σου του δάκη λάκη μάκη νάκη ράκη τάκη"),
}


def digits_of(mention: str) -> str:
    return re.sub(r"\D", "", mention)


def luhn_digit(digits: str) -> str:
    """The check digit to append."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def is_card(mention: str) -> bool:
    digits = digits_of(mention)
    return 13 <= len(digits) <= 19 and len(set(digits)) > 1 and luhn_digit(digits[:-1]) == digits[-1]


def is_address(mention: str) -> bool:
    return all(int(p) < 256 for p in mention.split("."))


class Stream:
    """Endless keyed random numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.block, self.left = key, "\x1f".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = blake2b(self.seed + b"\x1e" + str(self.block).encode(), key=self.key).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


ALPHABETS = [(97, 26), (65, 26), (48, 10), (0x430, 32), (0x410, 32), (0x3B1, 17), (0x391, 17)]  # first, letters


def redraw(text: str, stream: Stream, hex: bool = False) -> str:
    """Digits for digits, letters for letters of the same script and case; other characters stay."""
    out = []
    for c in text:
        if hex and c in "0123456789abcdef":
            out.append("0123456789abcdef"[stream.below(16)])
            continue
        for first, size in ALPHABETS:
            if first <= ord(c) < first + size:
                out.append(chr(first + stream.below(size)))
                break
        else:
            out.append(chr(97 + stream.below(26)) if c.isalpha() and c.islower() else c)
    return "".join(out)


def _longer(attempt: int, stream: Stream, draw: Callable[[Stream], str]) -> str:
    return "".join(draw(stream) for _ in range(max(0, attempt - LONGER + 1)))


def _letter(stream: Stream) -> str:
    return chr(97 + stream.below(26))


def _digit(stream: Stream) -> str:
    return str(stream.below(10))


def mail(norm: str, key: bytes, attempt: int) -> str:
    stream = Stream(key, "mail", norm, str(attempt))
    local, _, domain = norm.partition("@")
    labels = domain.split(".")
    host = ".".join(redraw(p, Stream(key, "domain", p)) for p in labels[:-1])  # one domain stays one domain
    return f"{redraw(local, stream)}{_longer(attempt, stream, _letter)}@{host}.{labels[-1]}"


def phone(norm: str, key: bytes, attempt: int) -> str:
    stream = Stream(key, "phone", norm, str(attempt))
    keep = max(0, len(norm) - 10)  # the country code
    return norm[:keep] + str(2 + stream.below(8)) + redraw(norm[keep + 1:], stream) + _longer(attempt, stream, _digit)


def card(norm: str, key: bytes, attempt: int) -> str:
    stream = Stream(key, "card", norm, str(attempt))
    body = norm[0] + redraw(norm[1:-1], stream) + _longer(attempt, stream, _digit)
    return body + luhn_digit(body)


def address(norm: str, key: bytes, attempt: int) -> str:
    stream = Stream(key, "address", norm, str(attempt))
    return ".".join(str(1 + stream.below(254)) for _ in range(4)) + (f".{_longer(attempt, stream, _digit)}" if attempt >= LONGER else "")


def social(norm: str, key: bytes, attempt: int) -> str:
    stream = Stream(key, "social", norm, str(attempt))
    return redraw(norm, stream) + _longer(attempt, stream, _digit)


def secret(norm: str, key: bytes, attempt: int) -> str:
    stream = Stream(key, "secret", norm, str(attempt))
    head = next((p for p in ("AKIA", "ASIA", "ghp_", "sk-") if norm.startswith(p)), "")
    hexadecimal = re.fullmatch(r"[0-9a-f]+", norm) is not None
    return head + redraw(norm[len(head):], stream, hexadecimal) + _longer(attempt, stream, _letter)


def iban(norm: str, key: bytes, attempt: int) -> str:
    stream = Stream(key, "iban", norm, str(attempt))
    body = redraw(norm[4:], stream) + _longer(attempt, stream, _digit)
    number = int("".join(str(int(c, 36)) for c in body + norm[:2] + "00"))
    return f"{norm[:2]}{98 - number % 97:02d}{body}"


def is_iban(mention: str) -> bool:
    norm = mention.replace(" ", "")
    return 15 <= len(norm) <= 34 and int("".join(str(int(c, 36)) for c in norm[4:] + norm[:4])) % 97 == 1


def script_of(name: str) -> str:
    first = ord(name[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 else "latin"


def person(norm: str, key: bytes, attempt: int) -> str:
    """norm is gender:name in lower case (n: no title tells it); as many words as the name has, first names only before a
    last name. With every second attempt the last name gets one more syllable, which makes room without end."""
    gender, _, name = norm.partition(":")
    stream, script, words = Stream(key, "person", norm, str(attempt)), script_of(name), name.split()
    firsts = " ".join(FIRST[script, g] for g in ("mf" if gender == "n" else gender)).split()
    start, inner, end = (part.split() for part in LAST[script])
    out = [firsts[stream.below(len(firsts))] for _ in words[:-1]]
    middle = [inner[stream.below(len(inner))] for _ in range(1 + attempt // 2)]
    out.append("".join([start[stream.below(len(start))], *middle, end[stream.below(len(end))]]))
    return f"{gender}:{' '.join(out).lower()}"


@dataclass(frozen=True)
class Detector:
    pattern: re.Pattern
    normal: Callable[[re.Match], str]
    holds: Callable[[str], bool]
    surrogate: Callable[[str, bytes, int], str]
    hint: re.Pattern  # quick search that texts without a mention fail


_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_RANK = "|".join(t for t, g in TITLES.items() if g == "n")
_LOWER = "".join(c for c in map(chr, [*range(0x80, 0x530), *range(0x1E00, 0x2000)]) if c.islower())
_LETTER = r"(?:[^\W\d_][\u0300-\u036f]*)"
_CAPITAL = rf"[^\W\d_a-z{_LOWER}][\u0300-\u036f]*"
#: a word (O'Brien, Müller-Schmidt; not the s of a genitive), or initials (J., J.R., J.-P.; the last dot only before more)
_WORD = rf"{_CAPITAL}{_LETTER}+(?:['’](?!s(?!\w)){_LETTER}+|[-‐‑]{_LETTER}+)*|{_CAPITAL}['’](?!s(?!\w)){_LETTER}+(?:[-‐‑]{_LETTER}+)*"
_MORE = rf"(?=[ \u00a0]?-?(?:(?:{INSIDE.replace(' ', '|')})[ \u00a0])*{_CAPITAL})"
_INITIALS = rf"{_CAPITAL}(?:\.-?{_CAPITAL})*(?:\.{_MORE}|(?=\.)|{_MORE})(?!{_LETTER}{{2}})"
_PART = rf"(?:{_WORD}|{_INITIALS})"
_BETWEEN = rf"[ \u00a0](?:(?:{INSIDE.replace(' ', '|')})[ \u00a0])*"
_NAME = rf"(?:(?:{INSIDE.replace(' ', '|')})[ \u00a0])*(?!(?:{_RANK})\b){_PART}(?:{_BETWEEN}(?!(?:{_TITLE})\b){_PART})*"


def _gender(titles: str) -> str:
    """Of the first of several titles that tells it."""
    known = [TITLES[t] for t in re.findall(r"\w+", titles)]
    return next((g for g in known if g != "n"), "n")


#: what stands before a four-part number that is no address
_NO_VERSION = "".join(f"(?<!{w}{between})" for word in ("version", "release", "build", "revision") for w in (word, word.capitalize(), word.upper())
                      for between in (" ", ": ", " v"))


def _always(_: str) -> bool:
    return True


#: in order of precedence; group `x` is what is replaced
DETECTORS = {
    "mail": Detector(
        re.compile(r"(?<![\w.+-])(?P<x>[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})(?![\w-])"),
        lambda m: m["x"].lower(), _always, mail, re.compile("@")),
    "secret": Detector(
        re.compile(r"(?<![0-9A-Za-z])(?P<x>(?:AKIA|ASIA)[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,})(?![0-9A-Za-z])"
                   r"|\b(?i:password|passwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?(?P<y>(?!\w+://)(?=[^\s\"',;]*\d)[^\s\"',;]{6,})"),
        lambda m: m["x"] or m["y"], _always, secret, re.compile(r"AKIA|ASIA|ghp_|sk-|[=:]\s*[\"']?\S{6}")),
    "iban": Detector(
        re.compile(r"(?<!\w)(?P<x>[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?)(?!\w)"),
        lambda m: m["x"].replace(" ", ""), is_iban, iban, re.compile(r"[A-Z]{2}\d{2} ?[0-9A-Z]{4}")),
    "card": Detector(
        re.compile(r"(?<![\w.+-])(?P<x>\d{13,19}|\d{4}(?P<s>[ -])\d{4}(?P=s)\d{4}(?P=s)\d{1,7}|\d{4}(?P<z>[ -])\d{6}(?P=z)\d{5})(?![\w-])"),
        lambda m: digits_of(m["x"]), is_card, card, re.compile(r"\d{13}|\d{4}[ -]\d{4}")),
    "address": Detector(
        re.compile(rf"(?<![\w.]){_NO_VERSION}(?P<x>\d{{1,3}}(?:\.\d{{1,3}}){{3}})(?!\.?\w)"),
        lambda m: ".".join(str(int(p)) for p in m["x"].split(".")), is_address, address, re.compile(r"\d\.\d")),
    "social": Detector(
        re.compile(r"(?<![\w-])(?P<x>\d{3}-\d{2}-\d{4})(?![\w-])"),
        lambda m: m["x"], _always, social, re.compile(r"\d-\d")),
    "phone": Detector(
        re.compile(r"(?<![\w+])(?P<x>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"),
        lambda m: digits_of(m["x"]), lambda x: 8 <= len(digits_of(x)) <= 15, phone, re.compile(r"\+\d|\(\d{3}\)|\d[.-]\d")),
    "person": Detector(
        re.compile(rf"\b(?P<t>(?:{_TITLE})\b\.?(?:[ \u00a0](?:{_TITLE})\b\.?)*)[ \u00a0](?P<x>{_NAME})"),
        lambda m: f"{_gender(m['t'])}:{' '.join(m['x'].lower().split())}", _always, person, re.compile(rf"\b(?:{_TITLE})\b")),
}


# what texts without any mention lack, for Spark's own search: a text that has a hint of some kind has one of these
HINT_TEXTS = ["@", "ghp_", "sk-"]
HINT = "(?=[^a-z ])(?:" + "|".join([  # no lower-case letter begins them, which passes most places at once
    "AKIA", "ASIA", r"[=:][\s\p{Z}\x1c-\x1f\x85]*[\"']?[^\s]{6}", r"[A-Z]{2}\p{Nd}{2} ?[0-9A-Z]{4}", r"\p{Nd}{13}",
    r"\p{Nd}{4}[ -]\p{Nd}{4}", r"\p{Nd}[.-]\p{Nd}", r"\+\p{Nd}", r"\(\p{Nd}{3}\)", *sorted(TITLES),
]) + ")"


def may_mention(text: Column) -> Column:
    """False for most texts without a mention, and only for such."""
    found = text.rlike(HINT)
    for part in HINT_TEXTS:
        found = found | F.contains(text, F.lit(part))
    return F.coalesce(found, F.lit(False))


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form), none overlapping, in order."""
    found: list[tuple[int, int, str, str]] = []
    for kind, d in DETECTORS.items():
        if not d.hint.search(text):
            continue
        for m in d.pattern.finditer(text):
            group = "x" if m["x"] is not None else "y"
            a, b = m.span(group)
            at = bisect(found, (a,))
            free = (at == len(found) or b <= found[at][0]) and (at == 0 or found[at - 1][1] <= a)
            if free and d.holds(m[group]):
                found.insert(at, (a, b, kind, d.normal(m)))
    people = [m[3] for m in found if m[2] == "person"]
    return with_repeats(text, found, people) if people else found


def with_repeats(text: str, found: list[tuple[int, int, str, str]], people: list[str]) -> list[tuple[int, int, str, str]]:
    """The mentions and those of the same names without a title. A name has the gender of its first title that tells one.

    A short titled name ("Mr Smith") is the one full name of the text that ends in it and does not contradict its title.
    """
    full = sorted({p[2:] for p in people if " " in p})
    genders: dict[str, set[str]] = {f: {p[0] for p in people if p[2:] == f} - {"n"} for f in full}
    link: dict[str, str] = {}
    for norm in dict.fromkeys(people):
        fits = [f for f in full if f.endswith(" " + norm[2:]) and (norm[0] == "n" or genders[f] <= {norm[0]})]
        fits = [f for f in fits if genders[f] == {norm[0]}] or fits
        if len(fits) == 1:
            link[norm] = norm[:2] + fits[0]
    people = [link.get(p, p) for p in people]
    found = [(a, b, k, link.get(n, n) if k == "person" else n) for a, b, k, n in found]
    of: dict[str, str] = {}
    for norm in [p for p in people if p[0] != "n"] + people:
        of.setdefault(norm[2:], norm)
    out = [(a, b, k, of[n[2:]] if k == "person" and n[0] == "n" else n) for a, b, k, n in found]
    written = {text[a:b] for a, b, k, n in found if k == "person" and len(text[a:b].split()) == len(n.split())}
    written = {w for w in written if re.search(f"{_LETTER}{{2}}", w)}  # initials alone mean nobody elsewhere
    if not written:
        return out
    written |= {w.upper() for w in written}
    names = "|".join(r"\s+".join(map(re.escape, w.split())) for w in sorted(written, key=lambda w: (-len(w), w)))
    for m in re.finditer(rf"(?<!\w)(?<!\w[-‐‑'’])(?:{names})(?!\w)(?![-‐‑]\w)", text):
        a, b = m.span()
        at = bisect(out, (a,))
        norm = of.get(" ".join(m[0].lower().split()))
        if norm and (at == len(out) or b <= out[at][0]) and (at == 0 or out[at - 1][1] <= a):
            out.insert(at, (a, b, "person", norm))
    return out


def laid_out(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the layout of the mention."""
    if kind in ("phone", "card", "iban"):
        rest, out = list(surrogate), []
        for c in mention:
            out.append(rest.pop(0) if c.isalnum() and rest else c)
        return "".join(out + rest)
    if kind == "person":
        name = " ".join(surrogate.partition(":")[2].split()[-len(mention.split()):])  # of a short form the last parts
        return name.upper() if mention.isupper() else re.sub(r"(?<!\w)\w", lambda m: m[0].upper(), name)
    if kind == "mail":
        return surrogate.upper() if mention.isupper() else surrogate
    return surrogate


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, norm, surrogate of the distinct entities (kind, norm), all surrogates different within a kind and
    none of them an entity. Each round of draws is written; there are few, as collisions are rare."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "norm", "attempt")))
            drawn = [DETECTORS[k].surrogate(n, key, a) for k, n, a in rows]
            yield batch.append_column("surrogate", pa.array(drawn, pa.string()))

    def shown(c: str):  # a name without its gender
        return F.when(F.col("kind") == "person", F.substring(c, 3, 1 << 30)).otherwise(F.col(c)).alias("shown")

    real = entities.select("kind", shown("norm")).distinct()
    open_ = entities.select("kind", "norm", F.lit(0).alias("attempt"))
    settled = None
    while settled is None or open_.head(1):
        drawn = open_.mapInArrow(draw, "kind string, norm string, attempt int, surrogate string").select("*", shown("surrogate"))
        marked = drawn.join(real.withColumn("real", F.lit(True)), ["kind", "shown"], "left")
        if settled is not None:
            marked = marked.join(settled.select("kind", shown("surrogate"), F.lit(True).alias("held")), ["kind", "shown"], "left")
        else:
            marked = marked.withColumn("held", F.lit(None).cast("boolean"))
        turn = F.row_number().over(Window.partitionBy("kind", "shown").orderBy("norm"))
        good = (turn == 1) & F.col("real").isNull() & F.col("held").isNull()
        judged = cut_lineage(marked.withColumn("good", good).select("kind", "norm", "attempt", "surrogate", "good"), "draws")
        accepted = judged.where("good").select("kind", "norm", "surrogate")
        settled = accepted if settled is None else cut_lineage(settled.unionByName(accepted), "settled")
        open_ = judged.where("not good").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
    return settled


def one_gender(entities: DataFrame) -> DataFrame:
    """kind, norm and n (texts) with the column entity: a name whose titles tell no gender is the person of that name whose
    titles do, of the gender with more texts (ties: f)."""
    name, gender = F.substring("norm", 3, 1 << 30), F.substring("norm", 1, 1)
    told = entities.where((F.col("kind") == "person") & (gender != "n")).groupBy(F.lit("person").alias("kind"), name.alias("name")).agg(
        F.max_by("norm", F.struct("n", -F.ascii("norm"))).alias("told")
    )
    named = entities.withColumn("name", F.when((F.col("kind") == "person") & (gender == "n"), name))
    return named.join(told, ["kind", "name"], "left").select("kind", "norm", "n", F.coalesce("told", "norm").alias("entity"))


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """row (a struct of the columns, the text rewritten) and entities, the (kind, norm) found in it. Runs jobs."""
    small_batches(docs.sparkSession)
    secret_key = key.encode()

    @F.pandas_udf("array<struct<kind:string,norm:string>>")
    def detect(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"kind": k, "norm": n} for k, n in sorted({m[2:] for m in mentions(t)})] if t else [])

    entry = "array<struct<kind:string,norm:string>>"
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hinted = may_mention(F.col(f"`{text}`"))
    plain = docs.where(~hinted).select(whole.alias("row"), F.array().cast(entry).alias("entities"))
    # the texts that may hold a mention, searched once and written with what is found; numbers are given as they are read again
    marked = cut_lineage(docs.where(hinted).select(whole.alias("row"), detect(F.col(f"`{text}`")).alias("entities")), "marked")
    clean = marked.where(F.size("entities") == 0)
    found = cut_lineage(marked.where(F.size("entities") > 0).withColumn("at", F.monotonically_increasing_id()), "mentions")
    pairs = found.select("at", F.explode("entities").alias("e")).select("at", "e.*")
    entities = cut_lineage(one_gender(pairs.groupBy("kind", "norm").agg(F.count(F.lit(1)).alias("n"))), "entities")
    table = surrogates(entities.select("kind", F.col("entity").alias("norm")).distinct(), secret_key).withColumnRenamed("norm", "entity")
    table = entities.select("kind", "norm", "entity").join(table, ["kind", "entity"]).select("kind", "norm", "surrogate")
    known = pairs.join(table, ["kind", "norm"]).groupBy("at").agg(
        F.collect_list(F.struct("kind", "norm", "surrogate")).alias("known")  # what one text mentions
    )

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series, known: pd.Series) -> pd.Series:
        def of(text: str, pairs) -> str:
            by = {(p["kind"], p["norm"]): p["surrogate"] for p in pairs}
            out, at = [], 0
            for a, b, kind, norm in mentions(text):
                out += [text[at:a], laid_out(kind, text[a:b], by[kind, norm])]
                at = b
            return "".join([*out, text[at:]])

        return pd.Series([of(t, k) for t, k in zip(texts, known)], dtype=object)

    joined = found.join(known, "at")
    new = F.col("row").withField(f"`{text}`", rewrite(F.col("row")[text], F.col("known")))
    return plain.unionByName(clean.select("row", F.col("entities").cast(entry))).unionByName(joined.select(new.alias("row"), F.col("entities").cast(entry)))


def surrogate_texts(docs: DataFrame, key: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id, text, n_entities and kinds of every row."""
    slim = docs.select(F.col(f"`{id}`").alias(id), F.col(f"`{text}`").alias("text"))
    done = pseudonymised(slim, key)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("entities")["kind"])), ",")
    return done.select(F.col("row")[id].alias(id), F.col("row")["text"].alias("text"), F.size("entities").cast("long").alias("n_entities"), kinds.alias("kinds"))


def without_personal_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with rewritten texts, all other columns as they were."""
    return pseudonymised(docs, key, text).select("row.*")
