"""Language identification by hyperdimensional profiles.

Every letter class has a fixed random vector of +1 and -1. A trigram is the product of its
three letter vectors, the first rotated by two places and the second by one, so that order
matters; a document is the sum of its trigrams, and a language the sum of its documents'
unit vectors. A document gets the language whose profile has the largest cosine with it.

Trigrams stand around each letter, a non-letter on either side counting as a word edge.
Letters a-z have a class of their own, other letters share 37 classes by code point.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.arrow import apart, batch_of, chunks, code_points, texts_of

CLASSES, OTHER = 64, 37
UNKNOWN = "und"
_BITS = 6


@dataclass(frozen=True)
class Profiles:
    """Unit profile per language; `matrix` has one row per entry of `languages`."""

    languages: tuple
    matrix: np.ndarray
    seed: int

    @property
    def dimensions(self):
        return self.matrix.shape[1]


@lru_cache(maxsize=1)
def _letter_classes():
    """Class of every code point: 0 for what is no letter."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()[0]
            table[cp] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % OTHER
    return table


@lru_cache(maxsize=4)
def _letter_vectors(dimensions, seed):
    letters = np.random.default_rng(seed).integers(0, 2, (CLASSES, dimensions), dtype=np.int8)
    letters = letters * np.int8(2) - np.int8(1)
    return np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters


def document_vectors(texts, dimensions, seed):
    """Sum of the trigram vectors of each text (float32) and its number of letters."""
    classes = _letter_classes()
    edge = np.zeros(1, dtype=np.uint8)
    parts, lengths = [edge], []
    for text in texts:
        parts += [classes[code_points(text)], edge]
        lengths.append(len(parts[-2]) + 1)
    codes = np.concatenate(parts)
    middle = np.flatnonzero(codes)
    owner = np.searchsorted(np.cumsum(lengths), middle, side="left").astype(np.int64)
    n_letters = np.bincount(owner, minlength=len(texts))
    if not len(middle):
        return np.zeros((len(texts), dimensions), dtype=np.float32), n_letters
    wide = codes.astype(np.int32)
    grams = (wide[middle - 1] << 2 * _BITS) | (wide[middle] << _BITS) | wide[middle + 1]
    present = np.flatnonzero(np.bincount(grams, minlength=CLASSES**3))
    place = np.zeros(CLASSES**3, dtype=np.int64)
    place[present] = np.arange(len(present))
    counts = np.bincount(owner * len(present) + place[grams], minlength=len(texts) * len(present))
    counts = counts.reshape(len(texts), len(present)).astype(np.float32)
    first, second, third = _letter_vectors(dimensions, seed)
    bound = first[present >> 2 * _BITS] * second[(present >> _BITS) % CLASSES] * third[present % CLASSES]
    return counts @ bound.astype(np.float32), n_letters


def _unit(vectors):
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length == 0, 1, length)


def fit_profiles(docs, dimensions=512, seed=20, text="text", lang="lang"):
    """Profiles of the languages in `docs`.

    Rows with a null language, and texts without a letter, teach nothing. Each task sums unit
    vectors per language, so only languages x tasks vectors are shuffled and only one vector
    per language reaches the driver. No usable row gives profiles of no language.
    """
    schema = pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.float64()))])

    def sums(batches):
        total = {}
        for batch in batches:
            texts, langs = texts_of(batch), batch.column("lang").to_pylist()
            for a, b in chunks(texts):
                units = _unit(document_vectors(texts[a:b], dimensions, seed)[0].astype(np.float64))
                for name in set(langs[a:b]):
                    chosen = [i for i in range(b - a) if langs[a + i] == name]
                    total[name] = total.get(name, 0) + units[chosen].sum(axis=0)
        if total:
            yield batch_of(schema, list(total), [v.tolist() for v in total.values()])

    def add(key, group):
        summed = np.sum([np.asarray(v) for v in group["vector"]], axis=0)
        return group.head(1)[["lang"]].assign(vector=[summed.tolist()])

    named = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    shape = "lang string, vector array<double>"
    rows = (
        named.where("lang is not null and text is not null").mapInArrow(sums, shape)
        .groupBy("lang").applyInPandas(add, shape).collect()
    )
    rows = sorted((r for r in rows if np.any(r.vector)), key=lambda r: r.lang)
    matrix = np.array([r.vector for r in rows], dtype=np.float64).reshape(len(rows), dimensions)
    return Profiles(tuple(r.lang for r in rows), _unit(matrix).astype(np.float32), seed)


def identify(docs, profiles, text="text", prefix=""):
    """All columns of `docs` with `lang_pred` and `score`, the cosine clipped to 0..1.

    A null text, a text without a letter, and any text under profiles of no language get
    `und` and score 0. Equal cosines go to the language that sorts first. Repeated rows are
    judged alike; a very long text is one chunk of its own. Columns of these names that were
    there before, in whatever case, are replaced.
    """
    added = prefix + "lang_pred", prefix + "score"
    return apart(docs, {"text": text}, added, lambda rows: _identified(rows, profiles, *added))


def _identified(docs, profiles, pred, score):
    keep = docs.withColumnRenamed("text", "__text").select(*[c for c in docs.columns if c != "text"], "__text")
    matrix, names, seed = profiles.matrix, list(profiles.languages), profiles.seed

    def judge(batches):
        for batch in batches:
            texts = texts_of(batch, "__text")
            found, cosines = [], []
            for a, b in chunks(texts):
                vectors, letters = document_vectors(texts[a:b], matrix.shape[1], seed)
                if not names:
                    found += [UNKNOWN] * (b - a)
                    cosines += [0.0] * (b - a)
                    continue
                cosine = _unit(vectors) @ matrix.T
                best = cosine.argmax(axis=1)
                found += [names[j] if n else UNKNOWN for j, n in zip(best, letters)]
                cosines += np.where(letters > 0, np.clip(cosine.max(axis=1), 0, 1), 0).tolist()
            made = [pa.array(found, pa.string()), pa.array(cosines, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, pred, score])

    shape = keep.select("*").schema.add(pred, "string").add(score, "double")
    return keep.mapInArrow(judge, shape).withColumnRenamed("__text", "text")
