"""Language identification by mixture inference over n-gram likelihoods."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Letters of n-grams: A-Z lower-cased, bytes beyond ASCII as they are, all else one word edge.
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
#: Entries of a language's table of n-gram likelihoods.
TABLE = 1 << 16
#: More languages than this are refused, so that the tables on each executor stay within TABLE * LANGUAGES * 4 bytes.
LANGUAGES = 256
UNDETERMINED = "und"


def _features(data: np.ndarray) -> np.ndarray:
    """A table entry for each byte: its n-gram of three letters, those before the text's start being edges."""
    c = _LETTER[data].astype(np.uint32)
    code = c.copy()
    code[1:] |= c[:-1] << np.uint32(8)
    code[2:] |= c[:-2] << np.uint32(16)
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words (with what follows up to the next one) and the text that each lies in."""
    edge = _LETTER[data] == 0x20
    start = ~edge
    start[1:] &= edge[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = True
    at = np.flatnonzero(start)
    return at, np.searchsorted(offsets, at, "right") - 1


@dataclass
class LanguageModel:
    """Log likelihoods of n-grams: ``table[entry, language]``."""

    languages: list[str]
    table: np.ndarray

    def mixture(self, data: np.ndarray, offsets: np.ndarray, rounds: int = 12, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """For each text, the main language and its share in the mixture of the chosen set of languages.

        Expectation-maximisation fits the shares of all languages; the sets of the largest 1, 2, ... shares are fitted
        again, and the set with the best likelihood less ``penalty * log(words)`` for every language in it is taken.
        """
        n, k = len(offsets) - 1, len(self.languages)
        best, share = np.zeros(n, np.int64), np.zeros(n)
        at, owner = _units(data, offsets)
        if not len(at):
            return best, share
        likelihood = np.add.reduceat(self.table[_features(data)], at, axis=0).astype(np.float64)
        top = likelihood.max(axis=1)
        likelihood = np.maximum(np.exp(likelihood - top[:, None]), 1e-30)
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[heads, len(at)])
        texts = owner[heads]

        def fit(allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            shares = allowed / allowed.sum(axis=1, keepdims=True)
            for _ in range(rounds):
                weighted = likelihood * np.repeat(shares, sizes, axis=0)
                weighted /= weighted.sum(axis=1, keepdims=True)
                shares = np.add.reduceat(weighted, heads, axis=0) / sizes[:, None]
            total = (likelihood * np.repeat(shares, sizes, axis=0)).sum(axis=1)
            return shares, np.add.reduceat(np.log(total), heads)

        full, _ = fit(np.ones((len(texts), k)))
        rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
        chosen, score = None, np.full(len(texts), -np.inf)
        for size in range(1, k + 1):
            shares, fitted = fit((rank < size).astype(float))
            fitted -= penalty * size * np.log(sizes + 1.0)
            better = fitted > score
            if not better.any():  # a larger set would have to make up for more than one more penalty
                break
            chosen = shares if chosen is None else np.where(better[:, None], shares, chosen)
            score = np.maximum(score, fitted)
        best[texts], share[texts] = chosen.argmax(axis=1), chosen.max(axis=1)
        return best, share


def train_languages(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> LanguageModel:
    """Learn n-gram likelihoods from all rows whose text and language aren't null.

    The counts are gathered over every row and summed by language and table entry, ``TABLE`` entries a language at
    most; more than ``LANGUAGES`` languages raise ValueError. No rows give a model without languages.
    """
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for first, last, data, offsets in slices(batch.column(0)):
                if not len(data):
                    continue
                features = _features(data)
                for name in sorted(set(names[first:last])):
                    of = np.repeat([x == name for x in names[first:last]], np.diff(offsets))
                    if name not in sums and len(sums) > LANGUAGES:
                        raise ValueError(f"more than {LANGUAGES} languages")
                    sums[name] = sums.get(name, 0) + np.bincount(features[of], minlength=TABLE)
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=schema.names)

    counts = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang).mapInArrow(count, schema)
    # packed by language, so that what reaches the driver is one array of at most TABLE counts for each
    summed = counts.groupBy("lang", "entry").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list(F.struct("entry", "n")).alias("all"))
    rows = summed.limit(LANGUAGES + 1).toPandas().sort_values("lang", ignore_index=True)
    if len(rows) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    table = np.zeros((TABLE, len(rows)))
    for i, pairs in enumerate(rows["all"]):
        table[[p["entry"] for p in pairs], i] = [p["n"] for p in pairs]
    table = np.log((table + smoothing) / (table + smoothing).sum(axis=0, keepdims=True)) if len(rows) else table
    return LanguageModel(rows["lang"].tolist(), table.astype(np.float32))


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns of ``keep``, then two of these ``names``: the language (string) and its share of the text's words (double).

    A null text, one without a letter, or a model without languages gives ``und`` and 0. Texts are judged whole; nothing
    but the text is looked at; ties go to the language that sorts first. Repeated rows get equal results, an empty table
    none, and other columns aren't read. One pass, no shuffle; the model's size is bounded (see ``LANGUAGES``).
    """
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            best, share = [], []
            has_letter = np.array(batch.column(len(keep) + 1).to_pylist(), bool)
            for _, _, data, offsets in slices(batch.column(len(keep)), 1 << 19):
                b, s = model.mixture(data, offsets) if model.languages else (np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1))
                best.append(b)
                share.append(s)
            if not best:
                continue
            best, share = np.concatenate(best), np.concatenate(share)
            none = ~has_letter | (share <= 0)
            best[none], share[none] = len(model.languages), 0.0
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(known[best], pa.string()), pa.array(np.clip(share, 0, 1))], names=schema.names)

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter")
    return docs.select(*keep, text, letters).mapInArrow(run, schema)


def held_out(id_column: str, folds: int, fold: int) -> F.Column:
    """Whether crc32 of the id's text falls into a fold; false for a null id."""
    return F.coalesce((F.crc32(F.col(id_column).cast("string").cast("binary")) % folds) == fold, F.lit(False))
