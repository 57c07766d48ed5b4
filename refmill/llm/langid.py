"""Language of a text by sparse multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies are counted over all training texts. The weights are fitted with
follow-the-regularised-leader and elastic-net penalties on a bounded hash sample of them, drawn for each language,
and a part of that sample, kept apart, sets the temperature that calibrates the scores. It also shows how
well n-grams of texts usually fit their language, by which texts in none of the learned languages are told.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import column_list, in_parts, read_table, shared

ship_by_value(__name__)

BUCKETS = 1 << 15
ORDERS = 3  # n-grams of 1 to 3 characters
TRAIN_ROWS = 10_000  # expected size of the sample the weights are fitted on
MAX_LANGUAGES = 256  # learned, those with most labelled texts; weights grow with their number
STRANGE = 3.5  # how many times further below the median than the lowest twentieth a fit is strange
_BLOCK = 1024  # buckets summed in one group
_PART = 1 << 20  # characters of a text worked on at a time

_NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """Step size and offset of the leader, and the two penalties."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.1
    l2: float = 0.1
    epochs: int = 2


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket × language
    bias: np.ndarray
    temperature: float
    common: np.ndarray  # bucket × language, logarithm of its share
    least_fit: np.ndarray  # of a text's n-grams with each language


def fit_with(buckets: np.ndarray, counts: np.ndarray, common: np.ndarray, language: int) -> float:
    """How common a text's n-grams are in a language: mean logarithm of their shares."""
    weight = np.log1p(counts)
    return float(weight @ common[buckets, language] / weight.sum())


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the character n-grams of a whole text; none if it has no letter.

    Case and whatever stands between words are levelled; word ends are part of n-grams.
    """
    line = _NOT_LETTERS.sub(" ", text.lower())
    if not any(map(str.isalpha, line)):
        return np.zeros(0, np.int64), np.zeros(0)
    line = f" {line.strip()} "
    total = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - (BUCKETS - 1).bit_length())
    for at in range(0, len(line), _PART):
        codes = np.frombuffer(line[at : at + _PART + ORDERS - 1].encode("utf-32-le", "replace"), np.uint32)
        gram = np.zeros(len(codes), np.uint32)
        for n in range(ORDERS):  # n-grams that begin in this part; the next one repeats what they reach into
            gram = gram[: len(codes) - n] * np.uint32(0x01000193) + codes[n:] + np.uint32(n + 1)
            total += np.bincount((gram[:_PART] * np.uint32(0x9E3779B1)) >> shift, minlength=BUCKETS)
    buckets = np.flatnonzero(total)
    return buckets, total[buckets].astype(float)


def weighted(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[buckets]
    norm = math.sqrt(float(values @ values))
    return values / norm if norm else values


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader, one text at a time in the order given."""
    s = settings
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))  # the last row is the bias

    def leader(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for buckets, values, language in rows:
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0).astype(float)
            zi, ni = z[at], n[at]
            w = leader(zi, ni)
            p = softmax(x @ w)
            p[language] -= 1
            g = x[:, None] * p[None, :]
            root = np.sqrt(ni + g * g)
            z[at] = zi + g - (root - np.sqrt(ni)) / s.alpha * w
            n[at] = ni + g * g
    w = leader(z, n)
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / math.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in in_parts(batches):
        for text in column_list(batch, "text"):
            total[ngram_counts(text)[0]] += 1
            texts += 1
    parts = total.reshape(-1, _BLOCK)
    n = len(parts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int32()), pa.array([texts] * n, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
        ["block", "texts", "counts"],
    )


def _sum_block(table: pa.Table) -> pa.Table:
    counts = sum(np.frombuffer(c, np.int64) for c in table["counts"].to_pylist())
    block, texts = table["block"][0].as_py(), sum(table["texts"].to_pylist())
    return pa.table({"block": pa.array([block], pa.int32()), "texts": pa.array([texts], pa.int64()), "counts": pa.array([counts.tobytes()], pa.binary())})


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        made = [ngram_counts(t) for t in column_list(batch, "text")]
        buckets = pa.array([b.astype(np.int32).tobytes() for b, _ in made], pa.binary())
        counts = pa.array([c.astype(np.float32).tobytes() for _, c in made], pa.binary())
        names = ["lang", "pick"]
        kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
        yield pa.RecordBatch.from_arrays([*kept, buckets, counts], [*names, "buckets", "counts"])


def _shares(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int) -> np.ndarray:
    """Logarithms of the buckets' shares in each language."""
    total = np.full((BUCKETS, languages), 0.5)
    for buckets, counts, language in rows:
        total[buckets, language] += np.log1p(counts)
    return np.log(total / total.sum(axis=0)).astype(np.float32)


def _least_fits(rows: list[tuple[np.ndarray, np.ndarray, int]], common: np.ndarray) -> np.ndarray:
    """Per language the fit below which a text is strange to it; minus infinity where there is too little to tell."""
    if len(rows) < 20:
        return np.full(common.shape[1], -np.inf)
    fits, own = np.array([fit_with(b, c, common, y) for b, c, y in rows]), np.array([y for _, _, y in rows])
    enough = [(own == y).sum() >= 5 for y in range(common.shape[1])]
    middle = np.array([np.median(fits[own == y]) if e else np.median(fits) for y, e in enumerate(enough)])
    below = -np.quantile(fits - middle[own], 0.05)
    return middle - STRANGE * below


def _fit_group(idf: np.ndarray, languages: list[str], settings: Settings):
    number = {lang: n for n, lang in enumerate(languages)}

    def run(table: pa.Table) -> pa.Table:
        import pickle

        order = np.argsort(table["pick"].to_numpy(), kind="stable")
        langs, buckets, counts = (table[c].combine_chunks() for c in ("lang", "buckets", "counts"))
        rows, plain = [], []
        for i in order.tolist():  # views of the table's own memory, in single precision
            at = np.frombuffer(buckets[i].as_buffer(), np.int32)
            if len(at):
                count, language = np.frombuffer(counts[i].as_buffer(), np.float32), number[langs[i].as_py()]
                rows.append((at, weighted(at, count, idf).astype(np.float32), language))
                plain.append((at, count, language))
        apart, fitted = rows[::5], [r for i, r in enumerate(rows) if i % 5]
        weights, bias = fit(fitted or rows, len(languages), settings)
        logits = np.array([v @ weights[b] + bias for b, v, _ in apart]).reshape(-1, len(languages))
        temperature = fit_temperature(logits, np.array([y for _, _, y in apart], int))
        common = _shares([r for i, r in enumerate(plain) if i % 5] or plain, len(languages))
        packed = pickle.dumps((weights.astype(np.float32), bias, temperature, common, _least_fits(plain[::5], common)))
        return pa.table({"model": pa.array([packed], pa.binary())})

    return run


def quotas(rows: dict[str, int], total: int) -> dict[str, float]:
    """Share of each language's rows to draw, so that about ``total`` are drawn and small languages are drawn whole."""
    left, found = float(total), {}
    for n, (lang, count) in enumerate(sorted(rows.items(), key=lambda x: (x[1], x[0]))):
        drawn = min(count, left / (len(rows) - n))
        found[lang] = drawn / count
        left -= drawn
    return found


def drawn(labelled: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``text, lang, pick``: of each language that share of ``(doc_id, text, lang)``, by a hash of doc_id and text.

    The draw is the same at every partitioning; ids may be null or repeated. ``pick`` is spread evenly in each language.
    """
    scale = 1 << 30
    limits = F.create_map(*[F.lit(x) for lang, share in shares.items() for x in (lang, max(1, int(scale * share)))])
    hashed = labelled.select("text", "lang", F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale)).alias("hash"), limits[F.col("lang")].alias("limit"))
    return hashed.where("hash < limit").select("text", "lang", (F.col("hash") / F.col("limit")).alias("pick"))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, settings: Settings = Settings(), max_languages: int = MAX_LANGUAGES) -> Model | None:
    """Model of the labelled ``(doc_id, text, lang)``; None where no row has a text and a language.

    The ``max_languages`` with most labelled texts are learned. The sample holds about ``train_rows`` rows, as many of each language as
    there are, so that rare ones are learned from all their rows. Rows repeated as a whole count once in it.
    """
    import pickle

    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counted = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    rows = {r.lang: r["count"] for r in counted}
    if not rows:
        return None
    languages = sorted(rows)
    kind = "block int, texts bigint, counts binary"
    blocks = labelled.select("text").mapInArrow(_document_frequencies, kind).groupBy("block").applyInArrow(_sum_block, kind).collect()
    texts = blocks[0].texts
    frequency = np.concatenate([np.frombuffer(b.counts, np.int64) for b in sorted(blocks)])
    idf = np.log((1 + texts) / (1 + frequency))
    sample = drawn(labelled, quotas(rows, train_rows))
    features = sample.mapInArrow(_features, "lang string, pick double, buckets binary, counts binary").distinct()
    fitted = features.groupBy(F.lit(1).alias("all")).applyInArrow(_fit_group(idf, languages, settings), "model binary").collect()
    if not fitted:
        return None
    return Model(languages, idf, *pickle.loads(fitted[0].model))


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model()
        for batch in in_parts(batches):
            languages, scores, familiar = [], [], []
            for text in column_list(batch, "text"):
                buckets, counts = ngram_counts(text or "")
                if m is None or not len(buckets):
                    languages.append("und")
                    scores.append(0.0)
                    familiar.append(False)
                    continue
                logits = weighted(buckets, counts, m.idf) @ m.weights[buckets] + m.bias
                p = softmax(logits / m.temperature)
                best = int(p.argmax())
                languages.append(m.languages[best])
                scores.append(float(p[best]))
                familiar.append(bool(fit_with(buckets, counts, m.common, best) >= m.least_fit[best]))
            kept = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(familiar, pa.bool_())],
                [*names, "lang_pred", "score", "familiar"],
            )

    return run


def held_out(doc_id: Column) -> Column:
    """The fold that training leaves out; a null id is in neither fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, familiar`` of every row; ``und`` and 0 for texts without a letter or without a model.

    Not ``familiar`` are texts whose n-grams are strangely rare in the predicted language: it is only the nearest of those learned.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(_predict(shared(docs.sparkSession, model)), "doc_id bigint, lang_pred string, score double, familiar boolean")


def identify_languages(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, familiar`` with a model of the rows outside the held-out fold.

    Rows without doc_id, text or lang train nothing but are predicted like others.
    """
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    found = identify(docs, train(known, train_rows))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "familiar")


def confident(docs: DataFrame, least: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised with a score of ``least`` or more and familiar.

    A text in a language that was not learned has a nearest one all the same; it goes because its n-grams are strange to that. Repeated rows stay or go together. The text travels with its prediction, so no join is needed.
    """
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return docs.mapInArrow(_keep(shared(docs.sparkSession, train(known, train_rows)), least), docs.schema)


def _keep(model, least: float):
    predict = _predict(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            text = batch.schema.get_field_index("text")
            for found in predict(iter([pa.RecordBatch.from_arrays([batch.column(text)], ["text"])])):
                kept = zip(*[found[c].to_pylist() for c in ("lang_pred", "score", "familiar")])
                keep = [lang != "und" and s >= least and known for lang, s, known in kept]
                yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def op10_ftrl_language(spark, sf_dir):
    """Language of all documents, learned from those outside the held-out fold."""
    return identify_languages(read_table(spark, sf_dir, "documents"))
