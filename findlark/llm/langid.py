"""Language ID by hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.llm.common import batches_of, ship

ship(__name__)

DIMENSIONS = 1024
ORDER = 3
SEED = 20240229
UNKNOWN = "und"
# bytes of text worked on at once, and n-grams bound at once: bounds of a task's memory
BATCH_BYTES = 1 << 20
BLOCK = 2048
SPACE = 32


class Space:
    """Random vectors of letters, and the n-gram vectors bound from them."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.known: dict[int, np.ndarray] = {}
        self.plain: np.ndarray | None = None

    def letter(self, code: int) -> np.ndarray:
        """+1/-1 vector of one letter, the same wherever it is made."""
        if code not in self.known:
            bits = np.random.Generator(np.random.Philox(key=[self.seed, code])).integers(0, 2, self.dimensions, np.int8)
            self.known[code] = 2 * bits - 1
        return self.known[code]

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams (rows of code points): the product of the letters' vectors, each
        rotated by its distance from the end, so the order of letters counts."""
        out = np.ones((len(grams), self.dimensions), np.float32)
        for place in range(grams.shape[1]):
            codes, which = np.unique(grams[:, place], return_inverse=True)
            turn = grams.shape[1] - 1 - place
            out *= np.stack([np.roll(self.letter(int(c)), turn) for c in codes])[which]
        return out

    def letters(self, text: str) -> np.ndarray:
        """Lower-cased letters of a text as code points, every run of others as one space."""
        if self.plain is None:
            self.plain = np.zeros(0x110000, bool)
            for start in range(0, 0x110000, 0x10000):
                block = "".join(map(chr, range(start, start + 0x10000)))
                self.plain[start : start + 0x10000] = [c.isalpha() for c in block]
        raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(self.plain[raw], raw, SPACE)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
        return codes[keep]


def profiles(texts: list[str | None], space: Space, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The bundled n-gram vectors of texts, one row each, and whether the text has a letter.

    The vector of a text is the sum of the vectors of all its n-grams: counts of the batch's
    n-grams times their vectors, block by block.
    """
    parts, owner, letters = [], [], np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        codes = space.letters(text or "")
        letters[i] = bool((codes != SPACE).any())
        if letters[i]:
            edge = np.array([SPACE], np.uint32)
            codes = np.concatenate([edge[int(codes[0] == SPACE) :], codes, edge[int(codes[-1] == SPACE) :]])
            codes = np.concatenate([np.full(max(0, order - len(codes)), SPACE, np.uint32), codes])
            parts.append(codes)
            owner.append(i)
    out = np.zeros((len(texts), space.dimensions), np.float32)
    if not parts:
        return out, letters
    # letters as small numbers, so an n-gram is one number
    codes = np.concatenate(parts)
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(alphabet[-1] + 1, np.int32)
    number[alphabet] = np.arange(len(alphabet))
    small, size = number[codes], len(alphabet)
    gram = np.zeros(len(small) - order + 1, np.int32 if size**order < 1 << 31 else np.int64)
    for place in range(order):
        gram = gram * size + small[place : place + len(gram)]
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    inside = doc[: len(gram)] == doc[order - 1 :]
    gram, doc = gram[inside], doc[: len(inside)][inside]
    if size**order <= 1 << 22:
        used = np.flatnonzero(np.bincount(gram, minlength=size**order))
        number = np.zeros(size**order, np.int32)
        number[used] = np.arange(len(used))
        gram = number[gram]
    else:
        used, gram = np.unique(gram, return_inverse=True)
    powers = size ** np.arange(order - 1, -1, -1)
    rows = np.zeros((len(parts), space.dimensions), np.float32)
    for start in range(0, len(used), BLOCK):
        block = used[start : start + BLOCK]
        own = slice(None) if len(used) <= BLOCK else (gram >= start) & (gram < start + BLOCK)
        counts = np.bincount(doc[own] * len(block) + (gram[own] - start), minlength=len(parts) * len(block))
        vectors = space.bound(alphabet[(block[:, None] // powers) % size])
        rows += counts.reshape(len(parts), len(block)).astype(np.float32) @ vectors
    out[owner] = rows
    return out, letters


def is_held_out():
    """Whether a document is kept out of learning: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learn(
    docs: DataFrame, dimensions: int = DIMENSIONS, order: int = ORDER, seed: int = SEED
) -> dict[str, np.ndarray]:
    """A prototype per language: the sum of the unit profiles of all its learning documents.

    Each task adds up its own documents, so one row per task and language is shuffled and one
    row per language reaches the driver. Sums are whole numbers, so their order is no matter.
    """
    space = Space(dimensions, seed)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in batches_of([whole], "text", BATCH_BYTES)):
            langs = np.array(batch.column(1).to_pylist(), object)
            rows, has = profiles(batch.column(0).to_pylist(), space, order)
            length = np.linalg.norm(rows, axis=1, keepdims=True)
            rows = np.rint(rows / np.where(length > 0, length, 1) * 10_000).astype(np.int64)
            for lang in set(langs[has]):
                total[lang] = total.get(lang, 0) + rows[has & (langs == lang)].sum(axis=0)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))],
                ["lang", "sums"],
            )

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out())
    sums = known.select("text", "lang").mapInArrow(add, "lang string, sums array<long>")
    # one row per task and language; element-wise sums keep one row per language
    total = sums.select("lang", F.posexplode("sums").alias("at", "value"))
    total = total.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    whole = total.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("sums"))
    return {row["lang"]: np.array([v["value"] for v in row["sums"]], np.float64) for row in whole.collect()}


def identify(
    docs: DataFrame,
    prototypes: dict[str, np.ndarray] | None = None,
    dimensions: int = DIMENSIONS,
    order: int = ORDER,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    A text's letters, lower-cased, with each run of other characters as one space, are read as
    n-grams; each n-gram is the product of its letters' random +1/-1 vectors, rotated by place;
    their sum is compared with every language's prototype by cosine. The best one is the
    prediction (ties: the first by name), its cosine, at least 0, the score. Without letters
    or text, or with nothing learned, the prediction is ``und`` with score 0. Prototypes are
    learned from ``docs`` unless given: a vector per language.

    The whole text counts, however long. Ids, repeated rows and other columns are passed on as
    they are; columns named like the two new ones are replaced; no rows give no rows.
    """
    prototypes = learn(docs, dimensions, order, seed) if prototypes is None else prototypes
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] / max(1e-9, np.linalg.norm(prototypes[n])) for n in names]) if names else None
    space = Space(dimensions, seed)
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([
        *docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())
    ])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batches_of([whole], "text", BATCH_BYTES)):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            rows, has = profiles(texts, space, order)
            langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if names:
                length = np.linalg.norm(rows, axis=1)
                cosine = rows @ matrix.T / np.where(length > 0, length, 1)[:, None]
                best = cosine.argmax(axis=1)
                langs[has] = np.array(names, object)[best[has]]
                scores[has] = np.clip(cosine[np.arange(len(texts)), best][has], 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores)],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return docs.mapInArrow(predict, schema)
