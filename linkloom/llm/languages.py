"""Languages by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  An n-gram is
bound from its letters' vectors, each permuted (rolled) by its place; a text is the bundle
(sum) of its n-grams, a language the bundle of the n-grams of all its texts.  A document
gets the language whose prototype has the largest cosine with it.

Letters are compared in lower case; everything else is a word boundary, a "letter" of its
own, and no n-gram has two in a row.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.segments import released, slices
from linkloom.llm.shield import shielded, unshielded

DIMENSIONS = 512
N = 3
_SEED = 20_000
_BITS = 21
#: N-grams whose vectors a worker keeps at most.
_KEPT = 1 << 14
UNKNOWN = "und"
#: The pipeline rejects documents that are less like their language than this.
LEAST_SCORE = 0.1


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else 0."""
    found = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        character = chr(point)
        if character.isalpha():
            lower = character.lower()
            found[point] = ord(lower) if len(lower) == 1 else point
    return found


class _Vectors:
    """The vectors of n-grams."""

    def __init__(self) -> None:
        self._letter: dict[int, np.ndarray] = {}
        self._forget()

    def _forget(self) -> None:
        self._place: dict[int, int] = {}
        self._table = np.empty((1 << 12, DIMENSIONS), np.float32)

    def _letter_vector(self, point: int) -> np.ndarray:
        if point not in self._letter:
            draws = np.random.Generator(np.random.PCG64([_SEED, point])).integers(0, 2, DIMENSIONS)
            self._letter[point] = (2 * draws - 1).astype(np.float32)
        return self._letter[point]

    def _bound(self, gram: int) -> np.ndarray:
        vector = np.ones(DIMENSIONS, np.float32)
        for place in range(N):
            point = gram >> (_BITS * place) & ((1 << _BITS) - 1)
            vector *= np.roll(self._letter_vector(point), place)
        return vector

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the vectors of different n-grams, each as often as it occurs."""
        total = np.zeros(DIMENSIONS)
        for first in range(0, len(grams), _KEPT // 2):
            some = grams[first : first + _KEPT // 2].tolist()
            if len(self._place) + len(some) > _KEPT:
                self._forget()
            for gram in some:
                if gram not in self._place:
                    place = self._place[gram] = len(self._place)
                    if place == len(self._table):
                        self._table = np.concatenate([self._table, np.empty_like(self._table)])
                    self._table[place] = self._bound(gram)
            rows = np.array([self._place[g] for g in some])
            total += counts[first : first + len(some)].astype(np.float32) @ self._table[rows]
        return total


@functools.lru_cache(maxsize=1)
def _vectors() -> _Vectors:
    return _Vectors()


def _grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different n-grams of each text, and how often it has each."""
    table = _letters()
    for text in texts:
        points = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
        letters = table[points]
        if not letters.any():
            yield np.empty(0, np.int64), np.empty(0, np.int64)
            continue
        letters = np.concatenate([[0], letters, [0]])
        keep = np.ones(len(letters), bool)
        keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
        letters = letters[keep]
        length = len(letters) - N + 1
        codes = sum(letters[N - 1 - place :][:length] << (_BITS * place) for place in range(N))
        codes = np.sort(codes)
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        yield codes[starts], np.diff(np.append(starts, len(codes)))


def _summed(partial: DataFrame, keys: list[str]) -> DataFrame:
    def add(group: pd.DataFrame) -> pd.DataFrame:
        row = {k: [group[k].iloc[0]] for k in keys} | {"vector": [np.sum(np.stack(group["vector"].to_list()), 0)]}
        return pd.DataFrame(row)

    types = {"lang": "string", "bucket": "int"}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", vector array<double>"
    return partial.groupBy(*keys).applyInPandas(add, schema)


def prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """One vector for each value of ``lang``, from all rows with a ``lang``.

    What reaches the driver has as many rows as there are languages.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums: dict[str, np.ndarray] = {}
        for piece in slices(batches):
            by_lang: dict[str, list] = {}
            for lang, found in zip(piece.column("lang").to_pylist(), _grams(piece.column("text").to_pylist()), strict=True):
                by_lang.setdefault(lang, []).append(found)
            for lang, found in by_lang.items():
                grams, place = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([c for _, c in found]), len(grams))
                sums[lang] = sums.get(lang, 0) + _vectors().bundle(grams, counts)
        if sums:
            bucket = pa.array([TaskContext.get().partitionId() % 64] * len(sums), pa.int32())
            vectors = pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), bucket, vectors], ["lang", "bucket", "vector"])

    partial = labelled.where(F.col("lang").isNotNull()).select("lang", "text")
    partial = partial.mapInArrow(released(rows, _vectors), "lang string, bucket int, vector array<double>")
    summed = _summed(_summed(partial, ["lang", "bucket"]).select("lang", "vector"), ["lang"])
    return {r["lang"]: np.array(r["vector"]) for r in summed.collect()}


def predict(documents: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the cosine with that language, at least 0.

    A text that is NULL or has no letter is ``und`` with score 0, as every text is if no
    language was learned; of equal cosines the first name wins.
    """
    names = sorted(name for name, vector in model.items() if np.any(vector))
    matrix = np.stack([model[n] / np.linalg.norm(model[n]) for n in names], 1) if names else np.empty((DIMENSIONS, 0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found, scores = [], []
            for grams, counts in _grams(piece.column("text").to_pylist()):
                if not len(grams) or not names:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = _vectors().bundle(grams, counts)
                cosines = vector @ matrix / max(np.linalg.norm(vector), 1e-30)
                best = int(cosines.argmax())
                found.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            columns = [*piece.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*piece.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(released(rows, _vectors), f"{schema}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by id; a NULL id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def identify(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; the others are learned from."""
    model = prototypes(documents.where(~held_out(F.col("doc_id"))))
    asked = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(asked, model).drop("text")


def keep_identified(documents: DataFrame) -> DataFrame:
    """The documents, as they are, whose language is known with ``LEAST_SCORE`` or more."""
    model = prototypes(documents.where(~held_out(F.col("doc_id"))))
    found = predict(shielded(documents, ("text",)), model)
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return unshielded(kept, documents.columns, ("text",))
