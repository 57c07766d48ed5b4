"""Quality of texts from weak labels: overlapping heuristics, expectation-maximisation, a hashed linear scorer.

Heuristics vote good, bad or unsure on each text, or are silent where it is too short for them. They overlap:
what repeats itself, say, also compresses well. How often each is right is not known; it is estimated
from the votes of the whole corpus, counted by vote pattern, with two latent classes
in which labellers err independently. The posterior of a text's pattern is its soft label,
and a linear scorer over hashed features learns these labels on a bounded hash sample.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import column_list, in_parts, read_table, segments, shared, worker_state

ship_by_value(__name__)

BUCKETS = 1 << 16
TRAIN_ROWS = 10_000  # expected size of the sample the scorer is fitted on
BAD, UNSURE, GOOD, SILENT = range(4)
WINDOW = 300  # words of a stretch in which different ones are counted
_PART = 1 << 20  # characters of a text worked on at a time
_TALLIES = 1 << 20  # counters of the words of a text that comes in parts

SPACE, LOWER, UPPER, DIGIT, MARK, BREAK, SYMBOL = range(7)


@dataclass(frozen=True)
class Labeller:
    """Votes bad or good by a measure: beyond ``bad`` the one, up to ``good`` the other."""

    measure: str
    bad: float
    good: float


#: thresholds run from good to bad, downwards where bad < good
LABELLERS = (
    Labeller("symbols", 0.04, 0.015),
    Labeller("capitals", 0.25, 0.12),
    Labeller("echoes", 0.08, 0.02),
    Labeller("top_word", 0.2, 0.12),
    Labeller("distinct", 0.15, 0.4),
    Labeller("word_length", 16.0, 10.0),
    Labeller("shouts", 0.08, 0.02),
    Labeller("sentence_ends", 0.015, 0.04),
    Labeller("repeated_lines", 0.3, 0.1),
    Labeller("digits", 0.25, 0.1),
    Labeller("compressed", 0.25, 0.33),
)


def _classes() -> np.ndarray:
    """Kind of each character of the basic plane; made once per worker."""
    state = worker_state()
    if "character_kinds" not in state:
        kinds = np.full(1 << 16, SYMBOL, np.int8)
        for code in range(1 << 16):
            group = unicodedata.category(chr(code))
            if group in ("Lu", "Lt"):
                kinds[code] = UPPER
            elif group[0] in "LM":
                kinds[code] = LOWER
            elif group[0] == "N":
                kinds[code] = DIGIT
            elif group[0] == "Z" or code == 9:
                kinds[code] = SPACE
        kinds[[ord(c) for c in ".,;:'\"!?()-–—’“”«»¿¡„…"]] = MARK
        kinds[[10, 13]] = BREAK
        state["character_kinds"] = kinds
    return state["character_kinds"]


def kinds_in_parts(text: str) -> Iterator[np.ndarray]:
    table = _classes()
    for at in range(0, len(text), _PART):
        codes = np.frombuffer(text[at : at + _PART].encode("utf-32-le", "replace"), np.uint32)
        yield np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], np.int8(SYMBOL))


class _Variety:
    """Share of different words, averaged over stretches of ``WINDOW`` words, the last one up to the end of the text.

    So it does not depend on the length of a text; one that is shorter is a single stretch.
    """

    def __init__(self) -> None:
        self.shares, self.recent, self.open = [], [], 0

    def add(self, words: list[str]) -> None:
        words = self.recent + words
        at = len(self.recent) - self.open
        while len(words) - at >= WINDOW:
            self.shares.append(len(set(words[at : at + WINDOW])) / WINDOW)
            at += WINDOW
        self.open, self.recent = len(words) - at, words[-WINDOW:]

    def value(self) -> float:
        if self.open:
            self.shares.append(len(set(self.recent)) / len(self.recent))
            self.open = 0
        return math.fsum(self.shares) / len(self.shares)


class _Words:
    """What the labellers ask of the words of a text that comes in parts."""

    def __init__(self) -> None:
        self.n = self.echoes = self.ends = self.size = 0
        self.last, self.variety, self.counts, self.tallies = None, _Variety(), Counter(), None
        self.packer = zlib.compressobj(1)

    def add(self, part: str) -> None:
        words = part.split()
        bare = [w.strip(".,;:!?%$&*#|") for w in words]
        self.echoes += sum(map(str.__eq__, bare, bare[1:])) + (bool(bare) and bare[0] == self.last)
        self.last = bare[-1] if bare else self.last
        self.ends += sum(w[-1] in ".!?…" for w in words)
        self.n += len(words)
        self.variety.add(bare)
        if self.counts:  # from the second part on words are counted by their hashes
            self._tally(self.counts)
        self.counts = Counter(bare)
        self.size += len(self.packer.compress(part.encode("utf-8", "replace")))

    def _tally(self, counts: Counter) -> None:
        import xxhash

        if self.tallies is None:
            self.tallies = np.zeros(_TALLIES, np.int64)
        at = np.fromiter((xxhash.xxh32_intdigest(w) % _TALLIES for w in counts), np.int64, len(counts))
        np.add.at(self.tallies, at, np.fromiter(counts.values(), np.int64, len(counts)))

    def top(self) -> int:
        if self.tallies is None:
            return max(self.counts.values())
        self._tally(self.counts)
        return int(self.tallies.max())

    def packed(self) -> int:
        return self.size + len(self.packer.flush())


def _lines(text: str) -> Iterator[str]:
    at = 0
    while at <= len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


def measures(text: str) -> dict[str, float]:
    """What the labellers look at, over the whole text in parts; nothing where a text is too short to tell."""
    count = np.zeros(7, np.int64)
    for kinds in kinds_in_parts(text):
        count += np.bincount(kinds, minlength=7)
    letters, shown = count[LOWER] + count[UPPER], len(text) - count[SPACE] - count[BREAK]
    words = _Words()
    for part in segments(text, _PART):
        words.add(part)
    n, found = words.n, {}
    if shown:
        found["symbols"], found["digits"] = count[SYMBOL] / shown, count[DIGIT] / shown
    if letters >= 20:
        found["capitals"] = count[UPPER] / letters
    if n:
        found["shouts"] = text.count("!") / n
    if n >= 40:
        found["echoes"] = words.echoes / n
        found["top_word"] = words.top() / n
        found["distinct"] = words.variety.value()
        found["word_length"] = shown / n
        found["compressed"] = words.packed() / len(text)
        found["sentence_ends"] = words.ends / n
    lines, different = 0, set()
    for line in _lines(text):
        if line and not line.isspace():
            lines += 1
            different.add(hash(line))
    if lines >= 4:
        found["repeated_lines"] = 1 - len(different) / lines
    return found


def votes(found: dict[str, float]) -> list[int]:
    cast = []
    for x in LABELLERS:
        value = found.get(x.measure)
        if value is None:
            cast.append(SILENT)
        elif x.bad > x.good:
            cast.append(BAD if value > x.bad else GOOD if value <= x.good else UNSURE)
        else:
            cast.append(BAD if value < x.bad else GOOD if value >= x.good else UNSURE)
    return cast


def pattern(cast: list[int]) -> int:
    """Votes as one number, below four to the number of labellers."""
    return sum(v * 4**i for i, v in enumerate(cast))


# ---- accuracies of the labellers


@dataclass(frozen=True)
class Accuracies:
    """Share of good texts, and how often each labeller that isn't silent casts each vote on bad and good ones."""

    good: float
    cast: np.ndarray  # labeller × class × vote; 1 for silence, which says nothing

    def posterior(self, ballots: np.ndarray) -> np.ndarray:
        """Probability of being good for rows of votes."""
        ratio = np.log(self.cast[:, 1]) - np.log(self.cast[:, 0])  # labeller × vote, for being good
        total = math.log(self.good / (1 - self.good)) + ratio[np.arange(len(ratio)), ballots].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -700, 700)))


def ballots_of(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 4**i % 4 for i in range(len(LABELLERS))], axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Accuracies:
    """Expectation-maximisation over counted vote patterns, from a text being bad if any labeller says so."""
    ballots = ballots_of(patterns)
    p = np.where((ballots == BAD).any(axis=1), 0.1, 0.9)
    found = Accuracies(0.5, np.ones((len(LABELLERS), 2, 4)))
    for _ in range(rounds):
        share = np.stack([counts * (1 - p), counts * p])
        cast = np.ones((len(LABELLERS), 2, 4))
        for i, c in np.ndindex(len(LABELLERS), 2):
            said = np.array([share[c, ballots[:, i] == v].sum() + 0.5 for v in (BAD, UNSURE, GOOD)])
            cast[i, c, :3] = said / said.sum()
        found = Accuracies(float((share[1].sum() + 1) / (counts.sum() + 2)), cast)
        new = found.posterior(ballots)
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return found


# ---- scorer


def features(text: str, found: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: binned measures, runs of three character kinds, and words, all hashed."""
    import xxhash

    digest = xxhash.xxh32_intdigest
    binned = [f"{k}={math.floor(math.log2(v + 1e-4) * 2)}" for k, v in found.items()]
    buckets = [digest(b) % BUCKETS for b in binned]
    runs, before = np.zeros(343, np.int64), np.zeros(0, np.int64)
    for part in kinds_in_parts(text):
        kinds = np.concatenate([before, part])
        runs += np.bincount(kinds[:-2] * 49 + kinds[1:-1] * 7 + kinds[2:], minlength=343) if len(kinds) > 2 else 0
        before = kinds[-2:]
    at = np.flatnonzero(runs)
    hashed: dict[int, int] = {}
    for part in segments(text, _PART):
        for word, n in Counter(part.lower().split()).items():
            bucket = digest(word, 1) % BUCKETS
            hashed[bucket] = hashed.get(bucket, 0) + n
    words = 0.3 * _unit(np.sqrt(np.fromiter(hashed.values(), float, len(hashed))))
    values = np.concatenate([np.ones(len(binned)), np.sqrt(runs[at] / max(1, len(text))), words])
    return np.array([*buckets, *[digest(f"kinds {a}") % BUCKETS for a in at], *hashed], np.int64), values


def _unit(x: np.ndarray) -> np.ndarray:
    return x / math.sqrt(float(x @ x)) if len(x) else x


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 3, rate: float = 0.2, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic scorer of soft labels by adaptive gradient steps, in the order given."""
    w, seen = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-3)
    for _ in range(epochs):
        for buckets, values, label in rows:
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0).astype(float)
            g = (_sigmoid(float(w[at] @ x)) - label) * x + decay * w[at]
            np.add.at(seen, at, g * g)
            np.add.at(w, at, -rate * g / np.sqrt(seen[at]))
    return w[:-1], float(w[-1])


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


@dataclass(frozen=True)
class Model:
    accuracies: Accuracies
    weights: np.ndarray
    bias: float


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in in_parts(batches):
        seen.update(pattern(votes(measures(t or ""))) for t in column_list(batch, "text"))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["pattern", "texts"]
    )


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        patterns, buckets, values = [], [], []
        for text in column_list(batch, "text"):
            found = measures(text or "")
            b, v = features(text or "", found)
            patterns.append(pattern(votes(found)))
            buckets.append(b.astype(np.int32).tobytes())
            values.append(v.astype(np.float32).tobytes())
        pick = batch.column(batch.schema.get_field_index("pick"))
        yield pa.RecordBatch.from_arrays(
            [pick, pa.array(patterns, pa.int64()), pa.array(buckets, pa.binary()), pa.array(values, pa.binary())],
            ["pick", "pattern", "buckets", "values"],
        )


def _fit_group(accuracies: Accuracies):
    def run(table: pa.Table) -> pa.Table:
        labels = accuracies.posterior(ballots_of(table["pattern"].to_numpy()))
        order = np.lexsort((table["pattern"].to_numpy(), table["pick"].to_numpy()))
        buckets, values = (table[c].combine_chunks() for c in ("buckets", "values"))
        rows = [  # views of the table's own memory, in single precision
            (np.frombuffer(buckets[i].as_buffer(), np.int32), np.frombuffer(values[i].as_buffer(), np.float32), float(labels[i]))
            for i in order.tolist()
        ]
        weights, bias = fit(rows)
        return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()), "bias": pa.array([bias], pa.float64())})

    return run


def sampled(docs: DataFrame, share: float) -> DataFrame:
    """``text, pick`` of that share of the rows of ``(doc_id, text)``, drawn by a hash of both: ids may be null or repeated."""
    scale = 1 << 30
    pick = F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale))
    return docs.select("text", pick.alias("pick")).where(F.col("pick") <= int(scale * min(1.0, share)))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Accuracies from the votes on all of ``(doc_id, text)``, scorer from a hash sample; None for an empty table.

    The sample holds ``train_rows`` rows on average and doesn't depend on partitioning. Rows
    repeated as a whole count once in it.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    # bounded by the votes the labellers can cast, whatever the corpus; hundreds of rows in practice
    counted = docs.select("text").mapInArrow(_count_patterns, "pattern bigint, texts bigint").groupBy("pattern").agg(F.sum("texts").alias("texts"))
    seen = sorted((r.pattern, r.texts) for r in counted.collect())
    if not seen:
        return None
    patterns, counts = (np.array(c) for c in zip(*seen))
    accuracies = estimate(patterns, counts.astype(float))
    made = sampled(docs, train_rows / counts.sum()).mapInArrow(_sample_features, "pick bigint, pattern bigint, buckets binary, values binary").distinct()
    fitted = made.groupBy(F.lit(1).alias("all")).applyInArrow(_fit_group(accuracies), "weights binary, bias double").collect()
    weights = np.frombuffer(fitted[0].weights, np.float32) if fitted else np.zeros(BUCKETS, np.float32)
    return Model(accuracies, weights, fitted[0].bias if fitted else 0.0)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model()
        for batch in in_parts(batches):
            ballots, scores = [], []
            for text in column_list(batch, "text"):
                found = measures(text or "")
                ballots.append(votes(found))
                buckets, values = features(text or "", found)
                scores.append(_sigmoid(float(m.weights[buckets] @ values) + m.bias))
            good = m.accuracies.posterior(np.array(ballots).reshape(-1, len(LABELLERS)))
            kept = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ballots, pa.list_(pa.int32())), pa.array(good, pa.float64()), pa.array(scores, pa.float64())],
                [*names, "votes", "weak_label", "score"],
            )

    return run


def classify(docs: DataFrame, least: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, votes, weak_label, score, keep`` of every row of ``(doc_id, text)``.

    ``votes`` are 0 bad, 1 unsure, 2 good, 3 silent, in the order of ``LABELLERS``; ``weak_label`` is their
    posterior, ``score`` the scorer's probability of a good text, ``keep`` whether it reaches
    ``least``. On null and empty texts all labellers are silent, and they are never kept. Repeated rows get equal results.
    """
    model = shared(docs.sparkSession, train(docs, train_rows))
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", (F.coalesce(F.length(F.trim("text")), F.lit(0)) > 0).alias("filled"))
    kind = "doc_id bigint, filled boolean, votes array<int>, weak_label double, score double"
    scored = rows.mapInArrow(_score(model), kind)
    return scored.select("doc_id", "votes", "weak_label", "score", (F.col("filled") & (F.col("score") >= least)).alias("keep"))


def keep_good(docs: DataFrame, least: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify`` would keep."""
    model = shared(docs.sparkSession, train(docs, train_rows))
    return docs.mapInArrow(_keep(model, least), docs.schema)


def _keep(model, least: float):
    score = _score(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            text = batch.column(batch.schema.get_field_index("text"))
            for found in score(iter([pa.RecordBatch.from_arrays([text], ["text"])])):
                filled = [bool(t and t.strip(" ")) for t in text.to_pylist()]
                keep = [f and s >= least for f, s in zip(filled, found["score"].to_pylist())]
                yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def op1_weak_label_quality(spark, sf_dir):
    """Weak label, score and decision for all documents."""
    return classify(read_table(spark, sf_dir, "documents"))
