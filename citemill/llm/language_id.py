"""Hierarchical language identification with linear support vector machines.

A text is a vector of hashed byte 1- to 4-grams over its letters. Linear SVMs first choose the language family, then
one-versus-one SVMs choose among the family's languages. They are fitted on the driver, on the features of at most `max_train`
distinct labelled texts, as many of each language: those with the smallest hash of their key and text. The MAX_LANGS most frequent
languages are learned. Prediction is one pass without a shuffle.

Defined results: a text that is null or has no letters is `und` with score 0; with no labelled text at all everything is
`und` with score 0; a language learned alone is predicted for every text with letters, with score 1; ties of votes go to
the larger sum of margins, then to the smaller name; labelled rows that repeat are learned once; an empty table gives no rows;
further columns pass through, but for those named as the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import binaries, extended, sliced, table

#: Families of languages by ISO 639-1 code. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "indo-aryan": "hi ur bn pa gu mr ne",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
MAX_TRAIN = 4000
MAX_LANGS = 200
DIM = 1 << 12
#: ASCII letters in lower case, other ASCII as spaces, the rest as it is.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: bytes) -> np.ndarray:
    """A unit vector of DIM square-rooted counts of hashed byte n-grams."""
    b = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    code, out = b.copy(), np.zeros(DIM)
    for n in range(1, 5):
        if len(b) < n:
            break
        if n > 1:
            code = (code[:-1] << np.uint32(8)) | b[n - 1 :]
        h = ((code * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)) >> np.uint32(20)
        out += np.bincount(h, minlength=DIM)
    out = np.sqrt(out)
    return (out / (np.linalg.norm(out) or 1)).astype(np.float32)


def fit_svm(xa: np.ndarray, xb: np.ndarray, *, c: float = 1000.0, rounds: int = 600, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """A linear SVM of class a against class b, with squared hinge loss, weighted alike. By accelerated gradient descent, in 32 bits,
    until the gradient is `tolerance` of the first one, or for so many rounds."""
    y = np.repeat(np.array([1, -1], np.float32), [len(xa), len(xb)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32) * np.float32(c)
    w = v = np.zeros(xa.shape[1], np.float32)
    bias = b = np.float32(0)
    step = np.float32(1 / (1 + 4 * float(weight.sum())))
    first = 0.0
    for k in range(rounds):
        slope = weight * y * np.maximum(np.float32(0), 1 - y * (np.concatenate([xa @ v, xb @ v]) + b)) * np.float32(2)
        gradient, along = v - slope[: len(xa)] @ xa - slope[len(xa) :] @ xb, -slope.sum()
        size = float(np.linalg.norm(gradient)) + abs(float(along))
        first = first or size
        if size <= tolerance * first:
            break
        new_w, new_b = v - step * gradient, b - step * along
        ahead = np.float32(k / (k + 3))
        v, b = new_w + ahead * (new_w - w), new_b + ahead * (new_b - bias)
        w, bias = new_w, new_b
    return w, float(bias)


class Hierarchy:
    """One-versus-one SVMs of families, and of the languages of each family. Rows are sorted by family and language."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        names = np.array(langs, dtype=object)
        self.languages: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.languages.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
        groups = np.array([FAMILY_OF.get(g, g) for g in langs], dtype=object)
        self.top = self._pairs(x, groups, sorted(self.languages))
        self.within = {f: self._pairs(x, names, own) for f, own in self.languages.items()}

    @staticmethod
    def _pairs(x: np.ndarray, of: np.ndarray, names: list[str]) -> dict[tuple[str, str], tuple[np.ndarray, float]]:
        out = {}
        rows = {}
        for n in names:  # neighbouring rows, so that nothing is copied
            own = np.flatnonzero(of == n)
            rows[n] = x[own[0] : own[-1] + 1]
        for a, b in combinations(names, 2):
            out[a, b] = fit_svm(rows[a], rows[b])
        return out

    @staticmethod
    def _vote(pairs: dict, names: list[str], x: np.ndarray) -> tuple[str, float]:
        """The winner, and the least confidence it won with."""
        votes, total, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), {n: np.inf for n in names}
        for (a, b), (w, bias) in pairs.items():
            m = float(x @ w) + bias
            for n, own in ((a, m), (b, -m)):
                votes[n] += own > 0
                total[n] += own
                least[n] = min(least[n], own)
        best = min(names, key=lambda n: (-votes[n], -total[n], n))
        return best, 1 / (1 + np.exp(-2 * float(np.clip(least[best], -50, 50))))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return "und", 0.0
        x = features(text.encode())
        family, sure = self._vote(self.top, sorted(self.languages), x)
        lang, surer = self._vote(self.within[family], self.languages[family], x)
        return lang, float(sure * surer)


def sample(labelled: DataFrame, key: Column, *, text_col: str = "text", lang_col: str = "lang", max_train: int = MAX_TRAIN, max_langs: int = MAX_LANGS) -> DataFrame | None:
    """(text, lang): distinct labelled texts, at most max_train and as many of each of the max_langs most frequent languages.

    Rows are first cut by a bound on their hash that lets some twice as many through, so that what is then grouped and ordered is
    bounded whatever the size of a language.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(key, F.col(text_col)).alias("h"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    if not counts:
        return None
    quota = max(1, max_train // len(counts))
    cuts = [(r.lang, int(-(2**63) + min(1.0, (2 * quota + 50) / r.n) * (2**64 - 1025))) for r in counts]
    bounds = labelled.sparkSession.createDataFrame(cuts, "lang string, cut long")  # at most max_langs rows
    few = rows.join(F.broadcast(bounds), "lang").where("h <= cut").groupBy("lang", "h").agg(F.first("text").alias("text"))
    return few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= quota).select("text", "lang", "h")


def fit(labelled: DataFrame, *, key: Column, **options) -> Hierarchy:
    """labelled: the rows that may be learned from; options as of sample()."""
    rows = sample(labelled, key, **options)
    if rows is None:
        return Hierarchy(np.zeros((0, DIM), np.float32), [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = [features(t).astype(np.float16).tobytes() for t in binaries(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), *batch.columns[1:]], ["x", "lang", "h"])

    got = rows.mapInArrow(run, "x binary, lang string, h long").toArrow().to_pydict()
    order = sorted(range(len(got["lang"])), key=lambda i: (FAMILY_OF.get(got["lang"][i], got["lang"][i]), got["lang"][i], got["h"][i]))
    langs, x = [got["lang"][i] for i in order], np.empty((len(order), DIM), np.float32)
    for row, i in enumerate(order):
        x[row] = np.frombuffer(got["x"][i], np.float16)
    del got
    return Hierarchy(x, langs)


def predict(docs: DataFrame, model: Hierarchy, *, text_col: str = "text") -> DataFrame:
    """docs with lang_pred (string) and score (double)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            got = [held.value.predict(t) for t in batch.column(text_col).to_pylist()]
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns |= {"lang_pred": pa.array([g for g, _ in got], pa.string()), "score": pa.array([s for _, s in got], pa.float64())}
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, extended(docs.schema, lang_pred="string", score="double"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text is a multiple of 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()), key=F.col("doc_id"))
    out = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
