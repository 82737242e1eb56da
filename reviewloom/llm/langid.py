"""Language identification by the nearest of several centroids per language, with rejection by distance.

Method: texts become normalised TF-IDF vectors of letter n-grams (1 to 3 letters, words marked by their ends,
hashed to WIDTH places; 1 + log of the count). Of each language a bounded sample of labelled texts is clustered
into up to CENTROIDS centroids (spherical k-means, fixed starts); a text has the language of the centroid of
largest cosine. A text is rejected if that cosine is below the limit of its length, which lies halfway between a high
quantile of the cosines that sample texts and cuts of them have with other languages than theirs (as a strange text
would) and a low quantile of the cosines by which they are found; it is the latter if the two overlap or one language
is learned. Lengths with few samples share their limit with shorter ones, so single odd texts set none.

Sample: at most PER_LANGUAGE texts a language, those of smallest hash of their id. Only this sample (text and
label) is learned from; its vectors, bounded by languages x PER_LANGUAGE, and the model, languages x CENTROIDS x WIDTH
numbers, are all that the driver sees.

Defined results: a null text or one without a letter is `und` with score 0, and rejected; so is every text if
nothing could be learned; rows without a label or id are not learned from; ties go to the language that sorts
first; repeated rows give repeated results (and count once in the sample); empty tables give empty results; other
columns don't matter. Texts are read whole, in training as in prediction.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from reviewloom.llm.shipping import ship, small_batches
from reviewloom.llm.words import mix, pieces
from reviewloom.session import cut_lineage

PER_LANGUAGE, CENTROIDS, WIDTH = 500, 4, 8192
#: quantiles of the cosines of strange and of known texts, the least samples of a length class with a limit of its own,
#: and the steps to which cosines are counted
STRANGE, KNOWN, LEAST, STEPS = 0.99, 0.005, 200, 1000
BROADCAST_IDS = 200_000
ROWS = 128  # texts of one dense matrix
TEXT = 256 << 10  # bytes of text whose n-grams are held at once (one longer text at least)


def letters() -> np.ndarray:
    """Which code points are letters, packed into bits."""
    return np.packbits(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)]))


def grams(texts: list[str], letter: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place) of every n-gram, and the number of letters of each text."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered])
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    codes = np.where(letter[codes.astype(np.int64)], codes, 0).astype(np.uint64)
    keep = (codes > 0) | np.concatenate(([True], codes[:-1] > 0))  # one mark between words
    codes, owner = codes[keep], owner[keep]
    counts = np.bincount(owner[codes > 0], minlength=len(texts))
    if len(codes) < 3:
        codes, owner = np.append(codes, np.zeros(3, np.uint64)), np.append(owner, np.zeros(3, np.int64))
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    one = mix(b + np.uint64(1 << 50))
    two = mix(a * np.uint64(0x110000) + b + np.uint64(2 << 50))
    three = mix((a * np.uint64(0x110000) + b) * np.uint64(0x110000) + c + np.uint64(3 << 60))
    mine, same = owner[1:-1], owner[:-2] == owner[1:-1]
    use1, use2, use3 = b > 0, same & ((a > 0) | (b > 0)), same & (b > 0) & (owner[2:] == mine)
    doc = np.concatenate([mine[use1], mine[use2], mine[use3]])
    place = np.concatenate([one[use1], two[use2], three[use3]]) % np.uint64(width)
    return doc, place.astype(np.int64), counts


def blocks(texts: list[str], letter: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Dense 1 + log counts of ROWS texts at a time, and the number of letters."""
    for at in range(0, len(texts), ROWS):
        part = texts[at:at + ROWS]
        doc, place, count = grams(part, letter, width)
        dense = np.bincount(doc * width + place, minlength=len(part) * width).reshape(len(part), width)
        yield np.log1p(dense, dtype=np.float32) + (dense > 0) * np.float32(1 - np.log(2)), count


def normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def length_class(letters_: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters_, 1)).astype(np.int64), 20)


@dataclass
class Model:
    names: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # columns
    language: np.ndarray  # of each centroid
    limits: np.ndarray  # by length class
    letter: np.ndarray

    def cosines(self, counts: np.ndarray) -> np.ndarray:
        return normal(counts * self.idf) @ self.centroids

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each text."""
        letter = np.unpackbits(self.letter).astype(bool)
        names, score, out = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        at = 0
        for counts, size in blocks([t or "" for t in texts], letter, len(self.idf)):
            if self.names:
                cos = self.cosines(counts)
                best = cos.argmax(axis=1)
                top = np.clip(cos[np.arange(len(cos)), best], 0, 1)
                known = size > 0
                score[at:at + len(cos)] = np.where(known, top, 0)
                out[at:at + len(cos)] = ~known | (top < self.limits[length_class(size)])
                names += [self.names[self.language[b]] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
            else:
                names += ["und"] * len(counts)
            at += len(counts)
        return names, score, out


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts are the row nearest the mean, then always the row furthest from all starts."""
    k = min(k, len(x))
    starts = [int((x @ x.mean(axis=0)).argmax())]
    while len(starts) < k:
        starts.append(int((x @ x[starts].T).max(axis=1).argmin()))
    centers = x[starts]
    for _ in range(rounds):
        near = (x @ centers.T).argmax(axis=1)
        sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else centers[j] for j in range(k)])
        centers = normal(sums)
    return centers


def cuts_of(text: str) -> list[str]:
    """Stretches of a sample text, of several lengths, from which limits for short texts are taken."""
    words, out, size = text.split(), [], 1
    while size < len(words):
        step = max(1, (len(words) - size) // 3)
        out += [" ".join(words[i:i + size]) for i in range(0, len(words) - size + 1, step)][:4]
        size *= 2
    return out


def sample(docs: DataFrame, train: Column, text: str, label: str, id: str, per_language: int) -> DataFrame:
    """The labelled texts to learn from: label and text, each id once.

    A language's share of hash space is set from its count so that about three times the sample lies below it; only
    those ids are ranked, so no task sees more of a language however large it is.
    """
    slim = docs.where(train & F.col(label).isNotNull() & F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(label).alias("label"))
    share = slim.groupBy("label").agg((F.lit(3.0 * per_language) / F.count(F.lit(1))).alias("share"))
    share = cut_lineage(share, "shares")
    if share.count() <= BROADCAST_IDS:
        share = F.broadcast(share)
    low = slim.join(share, "label").where(F.pmod(F.xxhash64("id"), F.lit(1 << 52)) / float(1 << 52) < F.col("share"))
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    ids = low.select("id", "label").distinct().withColumn("at", F.row_number().over(order)).where(F.col("at") <= per_language).drop("at")
    ids = cut_lineage(ids, "sample-ids")
    if ids.count() <= BROADCAST_IDS:  # languages x per_language; else Spark chooses the join
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(text).alias("text")).where("text is not null")
    return cut_lineage(texts.join(ids, ["id", "label"]), "sample")


def train(
    docs: DataFrame, learn: Column, text: str = "text", label: str = "lang", id: str = "doc_id",
    per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS, width: int = WIDTH,
) -> Model:
    """A model from the rows where `learn` holds."""
    small_batches(docs.sparkSession)
    bits = letters()
    letter_of = ship(docs.sparkSession, bits)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = np.unpackbits(letter_of()).astype(bool)
        for batch in batches:
            for piece in pieces([batch], "text", TEXT):
                texts, at = piece.column("text").to_pylist(), 0
                rows = []
                for counts, size in blocks(texts, letter, width):
                    for i in np.flatnonzero(size).tolist():
                        places = np.flatnonzero(counts[i])
                        rows.append((at + i, places.astype(np.int32).tobytes(), counts[i][places].tobytes()))
                    at += len(counts)
                if rows:
                    i, places, values = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("id").take(pa.array(i)), piece.column("label").take(pa.array(i)), pa.array(places), pa.array(values)],
                        ["id", "label", "places", "counts"],
                    )

    rows = sample(docs, learn, text, label, id, per_language)
    kinds = dict(rows.dtypes)
    found = rows.mapInArrow(vectors, f"id {kinds['id']}, label string, places binary, counts binary").dropDuplicates(["id", "label"])
    got = found.orderBy("label", F.xxhash64("id"), "id").collect()
    empty = Model([], np.zeros(width, np.float32), np.zeros((width, 0), np.float32), np.zeros(0, np.int64), np.zeros(21), bits)
    if not got:
        return empty
    x = np.zeros((len(got), width), np.float32)
    for i, row in enumerate(got):
        x[i, np.frombuffer(row["places"], np.int32)] = np.frombuffer(row["counts"], np.float32)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    x = normal(x * idf)
    names = sorted({r["label"] for r in got})
    own = np.array([names.index(r["label"]) for r in got])
    parts = [cluster(x[own == j], centroids) for j in range(len(names))]
    model = Model(names, idf, np.concatenate(parts).T.astype(np.float32), np.repeat(np.arange(len(names)), [len(p) for p in parts]), np.zeros(21), bits)
    model.limits = limits(rows, model, width)
    return model


def limits(rows: DataFrame, model: Model, width: int) -> np.ndarray:
    """The least cosine by length class, from the sample texts and cuts of them."""
    load = ship(rows.sparkSession, model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load()
        letter = np.unpackbits(own.letter).astype(bool)
        number = {name: i for i, name in enumerate(own.names)}
        for piece in pieces(batches, "text", TEXT):
            cuts, labels = [], []
            for text, name in zip(piece.column("text").to_pylist(), piece.column("label").to_pylist()):
                cuts += [text, *cuts_of(text)]
                labels += [number.get(name, -1)] * (len(cuts) - len(labels))
            at = 0
            for counts, size in blocks(cuts, letter, width):
                cos, label = own.cosines(counts), np.array(labels[at:at + len(counts)])
                at += len(counts)
                other = np.where(own.language == label[:, None], -1, cos).max(axis=1)
                step = lambda x: (np.clip(x, 0, 1) * STEPS).astype(np.int32)
                for strange, top in ((False, cos.max(axis=1)), (True, other)):
                    use = (size > 0) & (top >= 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(length_class(size[use]).astype(np.int32)), pa.array(np.full(use.sum(), strange)), pa.array(step(top[use]))],
                        ["length", "strange", "step"],
                    )

    found = rows.mapInArrow(measure, "length int, strange boolean, step int").groupBy("length", "strange", "step").count()
    known, strange = np.zeros((21, STEPS + 1), np.int64), np.zeros((21, STEPS + 1), np.int64)
    for row in found.collect():
        (strange if row["strange"] else known)[row["length"], row["step"]] = row["count"]
    return limits_of(known, strange)


def limits_of(known: np.ndarray, strange: np.ndarray) -> np.ndarray:
    """Limits by length class from counts by length class and cosine step."""
    out = np.zeros(21)
    top = 21
    while top > 0:  # from the longest class on, so many classes together that they have LEAST samples
        low = top - 1
        while low > 0 and known[low:top].sum() < LEAST:
            low -= 1
        k, s = known[low:top].sum(axis=0).cumsum(), strange[low:top].sum(axis=0).cumsum()
        least = np.searchsorted(k, KNOWN * k[-1], "right") / STEPS if k[-1] else 0.0
        most = np.searchsorted(s, STRANGE * s[-1]) / STEPS if s[-1] else least
        out[low:top] = min(least, (least + most) / 2)
        top = low
    # a text that is longer than another is not let in where that one is kept out
    return np.minimum.accumulate(out[::-1])[::-1]


def with_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """row (a struct of all columns), lang_pred, score and rejected of every document."""
    small_batches(docs.sparkSession)
    load = ship(docs.sparkSession, model)

    @F.pandas_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = load()
        for texts in batches:
            parts = []
            for piece in pieces([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])], "text", TEXT):
                names, score, out = own.predict(piece.column("text").to_pylist())
                parts.append(pd.DataFrame({"lang_pred": names, "score": score, "rejected": out}))
            yield pd.concat(parts) if parts else pd.DataFrame({"lang_pred": [], "score": [], "rejected": []})

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("row"), predict(F.col(f"`{text}`")).alias("p")).select("row", "p.*")


def held_out(id: str = "doc_id") -> Column:
    """True for the quarter of the ids that is never learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_table(docs: DataFrame, text: str = "text", label: str = "lang", id: str = "doc_id", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row; learned from what is not held out."""
    model = train(docs, ~held_out(id), text, label, id, **options)
    slim = docs.select(F.col(f"`{id}`").alias(id), F.col(f"`{text}`").alias("text"))
    found = with_language(slim, model)
    return found.select(F.col("row")[id].alias(id), held_out(f"row.{id}").alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame, text: str = "text", label: str = "lang", id: str = "doc_id", **options) -> DataFrame:
    """The documents that are not rejected, all columns as they were."""
    model = train(docs, ~held_out(id), text, label, id, **options)
    return with_language(docs, model, text).where(~F.col("rejected")).select("row.*")
