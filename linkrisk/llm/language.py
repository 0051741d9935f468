"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a trigram binds its letters, each
permuted by its place; a text bundles the vectors of its trigrams, a language prototype
those of its texts. A text gets the language whose prototype has the greatest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkrisk.llm.common import beside_text, map_batches, remembered, with_fields
from linkrisk.session import write_scratch

UNKNOWN = "und"
#: Coordinates of a vector, letters of an n-gram.
DIMENSIONS = 1024
#: Labelled texts of a language that the prototype is learnt from (expected number; a rarer language gives all).
LEARN_FROM = 1000
#: Trigram vectors that a worker remembers.
REMEMBERED = 40_000
_UNIT = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=4096)
def letter_vector(code: int) -> np.ndarray:
    """The fixed random vector of a code point."""
    return np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams, 21 bits a letter, and their counts; case folded, each run of other characters one space."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    before = np.concatenate(([False], letter[:-1]))
    kept = np.where(letter, codes, 32)[letter | before].astype(np.int64)
    kept = np.concatenate(([32], kept, [32])) if kept[-1] != 32 else np.concatenate(([32], kept))
    return np.unique(kept[:-2] << 42 | kept[1:-1] << 21 | kept[2:], return_counts=True)


class Memory:
    """Trigram vectors, made when first met and forgotten all at once when they are too many."""

    def __init__(self) -> None:
        remembered("language")
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((REMEMBERED, DIMENSIONS), dtype=np.int8)

    def add_up(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(DIMENSIONS, dtype=np.float64)
        for lo in range(0, len(grams), 4096):
            part = grams[lo : lo + 4096].tolist()
            if len(self.rows) + len(part) > REMEMBERED:
                self.rows.clear()
            at = [self.rows.get(g, -1) for g in part]
            for i, g in enumerate(part):
                if at[i] < 0:
                    at[i] = self.rows[g] = len(self.rows)
                    first, second, third = (letter_vector(g >> s & 0x1FFFFF) for s in (42, 21, 0))
                    self.vectors[at[i]] = np.roll(first, 2) * np.roll(second, 1) * third
            total += counts[lo : lo + 4096].astype(np.float32) @ self.vectors[at].astype(np.float32)
        return total

    def text(self, text: str | None) -> np.ndarray | None:
        """The bundled vector at length 1; None without a letter."""
        grams, counts = trigrams(text)
        if not len(grams):
            return None
        vector = self.add_up(grams, counts)
        length = np.linalg.norm(vector)
        return vector / length if length else vector


def learn(labelled: DataFrame, text: str, lang: str, key: str) -> dict[str, np.ndarray]:
    """Prototypes of length 1, centred on their mean, from a bounded sample of each language.

    A hash of the key decides on the sample. Vectors are added as integers, so the order of
    the rows does not matter; the driver receives one vector a language.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).where("lang is not null and text is not null")
    counts = rows.groupBy("lang").count().select(F.col("lang").alias("l"), (F.lit(float(LEARN_FROM)) / F.col("count")).alias("share"))
    counts = write_scratch(counts, "language-counts")  # its size is then known, so the texts need not move to meet it
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(counts, F.col("lang") == F.col("l")).where(chance < F.col("share")).select("lang", "text")

    def bundle(columns: dict[str, list]) -> dict[str, list] | None:
        memory, sums = Memory(), {}
        for language, body in zip(columns["lang"], columns["text"]):
            vector = memory.text(body)
            if vector is not None:
                sums[language] = sums.get(language, 0) + np.rint(vector * _UNIT).astype(np.int64)
        return {"lang": list(sums), "sum": [v.tolist() for v in sums.values()]} if sums else None

    parts = map_batches(sample, bundle, "lang string, sum array<long>")
    sums = parts.select("lang", F.posexplode("sum")).groupBy("lang", "pos").agg(F.sum("col").alias("sum"))
    found: dict[str, np.ndarray] = {}
    for language, pos, value in sums.collect():
        found.setdefault(language, np.zeros(DIMENSIONS))[pos] = value
    return {name: v / (np.linalg.norm(v) or 1.0) for name, v in sorted(found.items())}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` (the cosine, 0 to 1) of every whole text.

    A text that is null or has no letter is ``und`` with score 0, as is every text where
    nothing was learnt. Equal cosines give the language first in the alphabet.
    """
    names = list(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), DIMENSIONS)
    source, text_of = beside_text(docs, text, keep)
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            langs, scores = [], []
            for body in text_of(batch):
                vector = memory.text(body.as_py()) if names else None
                if vector is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                near = matrix @ vector
                best = int(np.argmax(near))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, near[best]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:kept], "lang_pred", "score"],
            )

    return source.mapInArrow(run, with_fields(docs.select(*keep), "lang_pred string, score double"))


def held_out(key: "F.Column") -> "F.Column":
    """Whether a document is kept from learning: CRC-32 of its key as text leaves 2 modulo 4. A null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """Learns from the labelled documents that are not held out and predicts all: ``keep``, ``lang_pred``, ``score``.

    Documents with a null key, label or text teach nothing and are predicted like the others.
    """
    prototypes = learn(docs.where(~held_out(F.col(key)) & F.col(key).isNotNull()), text, lang, key)
    return predict(docs, prototypes, text, [key] if keep is None else keep)


def accepts(text: "F.Column", least: float = 0.3, sure_from: int = 500) -> "F.Column":
    """The verdict on a prediction: a language is found, and a text of ``sure_from`` characters or more resembles it.

    The cosine of shorter texts says little, so these pass.
    """
    return (F.col("lang_pred") != UNKNOWN) & ((F.col("score") >= least) | (F.length(text) < sure_from))
