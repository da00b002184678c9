"""Language identification with error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Odd multipliers that mix the characters of an n-gram into its table row.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
SLICE = 1 << 18


def codewords(languages: int, bits: int | None = None) -> np.ndarray:
    """A -1/+1 codeword of ``bits`` bits for each language, far apart from each other.

    Up to five languages get every way to split them in two (each pair then differs in half of the
    bits); more get the best of some seeded random codes.
    """
    if languages == 1:
        return np.ones((1, 1), np.float32)
    if bits is None and languages <= 5:
        splits = range(1, 2 ** (languages - 1))
        return np.array([[1.0 if i and s >> (i - 1) & 1 else -1.0 for s in splits] for i in range(languages)], np.float32)
    bits = bits or 10 * int(np.ceil(np.log2(languages)))
    rng, best, far = np.random.default_rng(11), None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1.0, 1.0], np.float32), (languages, bits))
        gaps = bits - code @ code.T
        np.fill_diagonal(gaps, np.inf)
        if gaps.min() > far:
            best, far = code, gaps.min()
    return best


class Letters:
    """Code points to lower-case letters; everything that is no letter becomes one blank."""

    def __init__(self) -> None:
        self.table = np.zeros(0x110000, np.uint32)
        self.known = np.zeros(0x110000 >> 8, bool)

    def __call__(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        for page in np.unique(code >> 8):
            if not self.known[page]:
                for c in range(page << 8, (page + 1) << 8):
                    self.table[c] = ord(chr(c).lower()[0]) if chr(c).isalpha() else 32
                self.known[page] = True
        code = self.table[code]
        blank = code == 32
        return code[~(blank & np.concatenate([[False], blank[:-1]]))] if len(code) else code


def grams(code: np.ndarray, rows: int) -> np.ndarray:
    """Table rows of all 1-, 2- and 3-grams of one text, blanks at its ends included."""
    code = np.concatenate([[32], code, [32]]).astype(np.uint32)
    one = code * MIX[0]
    two = one[:-1] ^ (code[1:] * MIX[1] + np.uint32(1))
    three = two[:-1] ^ (code[2:] * MIX[2] + np.uint32(7))
    out = np.concatenate([one, two, three])
    return ((out ^ (out >> np.uint32(15))) % np.uint32(rows)).astype(np.int32)


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    for value in batch[column]:
        yield value.as_py() or ""


def count_grams(labelled: DataFrame, languages: list[str], rows: int) -> np.ndarray:
    """Grams of the (``lang``, ``text``) rows by language, summed in Spark: an array (languages, rows)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, by_lang = Letters(), {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), _texts(batch, "text"), strict=True):
                sums = by_lang.setdefault(lang, np.zeros(rows, np.int64))
                sums += np.bincount(grams(letters(text), rows), minlength=rows)
        for lang, sums in by_lang.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), lang, object), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])],
                names=["lang", "gram", "n"],
            )

    counted = labelled.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    out = np.zeros((len(languages), rows), np.float64)
    out[np.searchsorted(languages, found["lang"].to_pylist()), found["gram"].to_numpy()] = found["n"].to_numpy()
    return out


class Model:
    """Codewords and one naive-Bayes classifier of n-grams for each of their bits."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray) -> None:
        self.languages, self.code, self.weights = languages, code, weights

    def margins(self, text: str, letters: Letters) -> np.ndarray | None:
        """Mean evidence of a text's n-grams for each bit; None if it has no letter."""
        code = letters(text)
        if not (code != 32).any():
            return None
        rows = grams(code, len(self.weights))
        total = np.zeros(self.weights.shape[1], np.float64)
        for at in range(0, len(rows), SLICE):
            total += self.weights[rows[at : at + SLICE]].sum(axis=0, dtype=np.float64)
        return total / len(rows)

    def decode(self, margins: np.ndarray, sharpness: float) -> tuple[str, float, float]:
        """Nearest codeword by loss: each bit costs log(1 + exp(-margin)), so that clear bits weigh more.

        Returns the language, its share of the softmax over all codewords and the gap to the second.
        """
        loss = np.logaddexp(0.0, -sharpness * self.code * margins).sum(axis=1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(loss.argmin())
        second = np.delete(share, best).max() if len(share) > 1 else 0.0
        return self.languages[best], float(share[best]), float(share[best] - second)


def train(
    labelled: DataFrame, lang: str = "lang", text: str = "text", per_language: int = 4_000, rows: int = 1 << 16, bits: int | None = None
) -> Model:
    """Fits the classifiers on about ``per_language`` whole texts of each language, chosen by hash of their texts.

    The driver gets one number per language and n-gram row, at most languages x ``rows`` of them.
    Rows without language or text teach nothing. Bits are trained on all languages, each with the same weight.
    """
    known = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 1), np.float32), np.zeros((rows, 1), np.float32))
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, min(1.0, per_language / sizes[name])).otherwise(share)
    draw = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    code = codewords(len(languages), bits)
    by_lang = count_grams(known.filter(draw < share), languages, rows)
    by_lang /= np.maximum(by_lang.sum(axis=1, keepdims=True), 1)
    smooth = 0.1 / rows
    weights = np.zeros((rows, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        for_it, against = by_lang[code[:, bit] > 0], by_lang[code[:, bit] < 0]
        if len(for_it) and len(against):
            weights[:, bit] = np.log(for_it.mean(axis=0) + smooth) - np.log(against.mean(axis=0) + smooth)
    return Model(languages, code, weights)


def predict(
    docs: DataFrame, model: Model, text: str = "text", sharpness: float = 4.0, ambiguous_below: float = 0.05
) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` to every row; whole texts are read.

    A text that is NULL or has no letter, or a model without languages, gives ``und`` with score 0, ambiguous. Ambiguous
    is also a text whose two nearest codewords are less than ``ambiguous_below`` apart. Repeated rows get
    the same answer. Columns called like the added ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.code, model.weights))

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, fitted = Letters(), Model(*shared.value)
        for texts in batches:
            out = []
            for value in texts:
                margins = fitted.margins(value, letters) if value and fitted.languages else None
                name, score, gap = (UNKNOWN, 0.0, 0.0) if margins is None else fitted.decode(margins, sharpness)
                out.append((name, score, gap < ambiguous_below))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    added = ["lang_pred", "score", "ambiguous"]
    kept = [c for c in docs.columns if c.lower() not in added]
    return docs.withColumn("_told", label(F.col(text))).select(*kept, *[f"_told.{c}" for c in added])
