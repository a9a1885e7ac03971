"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to 3 lowered code points; a feature's value is
its share of the text's n-grams times its inverse document frequency.  Document
frequencies come from every training document.  Weights are fitted by
follow-the-regularised-leader with an elastic-net penalty on a bounded sample
of labelled rows: shards of the sample are fitted side by side and averaged.
A temperature then calibrates the probabilities on sample rows that the fit
has not seen.

Bounds: BUCKETS features, ``sample_rows`` rows in the fit (an equal share for
each language, drawn by a hash of the row's key), and languages times BUCKETS
weights, which is what the driver holds and what tasks get: 0.5 MB a language,
checked against MODEL.  Texts are used whole.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows
without a language teach nothing but get a prediction; with no labelled row
at all every text is ``und``; ties go to the first language by name; equal
texts have equal results.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, fresh

BITS = 16
BUCKETS = 1 << BITS
ORDERS = 3
UNKNOWN = "und"
#: Bytes of the weights that tasks get by broadcast; more languages are an error, not a cut.
MODEL = 1 << 30
#: Fixed multipliers of the n-gram hash: odd, from the golden ratio.
MIX = np.uint32(0x9E3779B1)
STEP = np.uint32(0x85EBCA6B)


def grams(text: str) -> np.ndarray:
    """Buckets of all n-grams of a text, in order of n and position."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out, acc = [], np.zeros(0, dtype=np.uint32)
    for n in range(1, ORDERS + 1):
        if len(points) < n:
            break
        acc = points * MIX if n == 1 else acc[:-1] * STEP + points[n - 1 :] * MIX + np.uint32(n)
        out.append((acc ^ acc >> np.uint32(15)) * STEP >> np.uint32(32 - BITS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


def has_letter(text: str | None) -> bool:
    """Whether a text has a code point of a letter category; a new text is scanned by its distinct code points."""
    return bool(text) and any(unicodedata.category(c)[0] == "L" for c in set(text))


def document_frequencies(texts: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """How many texts there are, and in how many each bucket occurs."""

    def count(batches):
        seen, df, n = np.zeros(BUCKETS, dtype=bool), np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                n += 1
                seen[grams(t or "")] = True
                at = np.flatnonzero(seen)
                df[at] += 1
                seen[at] = False
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["bucket", "n"])

    rows = texts.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS, dtype=np.int64)
    real = rows[rows.bucket >= 0]
    out[real.bucket.to_numpy()] = real.n.to_numpy()
    return int(rows[rows.bucket < 0].n.sum()), out


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TF-IDF features of a text: buckets and values."""
    found = grams(text or "")
    at, n = np.unique(found, return_counts=True)
    return at, n / max(1, len(found)) * idf[at]


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> np.ndarray:
    """Follow-the-regularised-leader over rows of (buckets, values, class)."""
    z, n = np.zeros((classes, BUCKETS)), np.zeros((classes, BUCKETS))
    for _ in range(epochs):
        for at, x, y in rows:
            za, na = z[:, at], n[:, at]
            w = np.where(np.abs(za) <= l1, 0.0, -(za - np.sign(za) * l1) / ((beta + np.sqrt(na)) / alpha + l2))
            s = w @ x
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = p[:, None] * x
            sigma = (np.sqrt(na + g * g) - np.sqrt(na)) / alpha
            z[:, at] += g - sigma * w
            n[:, at] += g * g
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    sample_rows: int = 6000,
    shards: int = 6,
    alpha: float = 1.0,
    beta: float = 0.02,
    l1: float = 1e-5,
    l2: float = 1e-4,
    epochs: int = 3,
) -> dict:
    """The model of labelled rows: languages, IDF, weights and temperature."""
    labelled = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if len(langs) * BUCKETS * 8 > MODEL:
        raise ValueError(f"{len(langs)} languages: the model of so many isn't broadcast")
    if not langs:
        return {"langs": [], "idf": None, "weights": None, "temperature": 1.0}
    total, df = document_frequencies(labelled, "text")
    idf = np.log((1 + total) / (1 + df)) + 1
    share = sample_rows / len(langs)
    drawn = F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit(""))).bitwiseAND((1 << 40) - 1) / float(1 << 40)
    rate = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, share / counts[k]))]), F.col("lang")), F.lit(0.0))
    sample = labelled.filter(drawn < rate).select("text", "lang", F.xxhash64(F.lit(7), F.col("key").cast("string"), F.col("text")).alias("order"))
    sample = sample.withColumn("shard", F.pmod("order", F.lit(shards + 1)))  # the last shard calibrates
    shared = docs.sparkSession.sparkContext.broadcast((langs, idf))

    def rows_of(part: pd.DataFrame):
        names, weights = shared.value
        place = {k: i for i, k in enumerate(names)}
        part = part.sort_values("order", kind="stable")
        return [(*vector(t, weights), place[k]) for t, k in zip(part.text, part.lang)]

    def train(part: pd.DataFrame) -> pd.DataFrame:
        names, _ = shared.value
        w = ftrl(rows_of(part), len(names), alpha, beta, l1, l2, epochs)
        c, b = np.nonzero(w)
        return pd.DataFrame({"c": np.append(c, -1), "b": np.append(b, 0), "w": np.append(w[c, b], 1.0)})

    fitted = sample.filter(F.col("shard") < shards).groupBy("shard").applyInPandas(train, "c long, b long, w double")
    fitted = fitted.groupBy("c", "b").agg(F.sum(F.col("w").cast("decimal(38,15)")).cast("double").alias("w")).toPandas()
    weights = np.zeros((len(langs), BUCKETS))
    real = fitted[fitted.c >= 0]
    weights[real.c.to_numpy(), real.b.to_numpy()] = real.w.to_numpy() / max(1.0, fitted[fitted.c < 0].w.sum())
    model = {"langs": langs, "idf": idf, "weights": weights, "temperature": 1.0}
    model["temperature"] = _temperature(sample.filter(F.col("shard") == shards), model)
    return model


def _temperature(rows: DataFrame, model: dict) -> float:
    """The divisor of the logits with the least log loss on held-back sample rows, from a fixed grid."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def losses(batches):
        m = shared.value
        place = {k: i for i, k in enumerate(m["langs"])}
        total = np.zeros(len(grid))
        for batch in batches:
            for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, x = vector(t, m["idf"])
                s = (m["weights"][:, at] @ x)[None, :] / grid[:, None]
                s -= s.max(axis=1, keepdims=True)
                total += np.log(np.exp(s).sum(axis=1)) - s[:, place[k]]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid))), pa.array(total)], names=["i", "loss"])

    got = rows.select("text", "lang").mapInArrow(losses, "i long, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).toPandas()
    if not len(got) or not got.loss.sum() > 0:
        return 1.0
    return float(grid[int(got.sort_values(["loss", "i"]).i.iloc[0])])


def predictor(spark: SparkSession, model: dict):
    """A column function: text to struct(lang, score)."""
    table = None if not model["langs"] else np.ascontiguousarray((model["weights"] * model["idf"]).T)
    shared = spark.sparkContext.broadcast((model["langs"], table, model["temperature"]))

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        langs, w, temperature = shared.value
        names, scores = [], []
        for t in texts.to_pylist():
            if not langs or not has_letter(t):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            found = grams(t)
            if len(found) > BUCKETS:
                s = np.bincount(found, minlength=BUCKETS) @ w / len(found)
            else:
                s = w[found].sum(axis=0) / len(found)
            s = s / temperature
            p = np.exp(s - s.max())
            best = int(p.argmax())
            names.append(langs[best])
            scores.append(float(p[best] / p.sum()))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    return predict


def predict(df: DataFrame, model: dict, text: str | Column = "text", out: str = "language") -> DataFrame:
    """``df`` with a column ``out``: struct(lang, score) of each whole text."""
    return df.withColumn(out, predictor(df.sparkSession, model)(F.col(text) if isinstance(text, str) else text))


def keep_known(docs: DataFrame, model: dict, min_score: float = 0.3) -> DataFrame:
    """Rows whose text has a language with at least ``min_score``; the columns stay as they are."""
    name = fresh(docs, "language")
    found = predict(docs, model, out=name)
    return found.filter((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= min_score)).select(*docs.columns)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may teach: crc32 of the id modulo 5 isn't 0."""
    return docs.filter(crc_mod("doc_id", 5) != 0)


def op10_language_id(docs: DataFrame) -> DataFrame:
    """Predicted language of every document, learnt from the training rows."""
    model = fit(training_rows(docs))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )
