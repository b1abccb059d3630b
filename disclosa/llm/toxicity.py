"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word has two places in one embedding table; filters of several widths slide over the words, the largest response of
each filter feeds a logistic output. Training is plain numpy (Adam) on all labelled rows outside the fold: learners take
equal shares of them, start a round from the same model, and their models are averaged, an embedding over the learners
that met its words. Words that training never saw keep a zero embedding and say nothing. Scores never see a language; a
threshold for each language is calibrated on one labelled row in CALIBRATE, all of which training leaves out, and gives
the further column flagged. A language with few rows there, and rows without one, share a threshold calibrated on all of them.

Null and empty texts get the score of a text without words; texts are scored whole; repeated rows get equal scores; an
empty table gives an empty result; without labelled rows of both classes every score is 0; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import discard, free_shuffles, give_back, kept_by_worker, materialise, pieces, small_batches, thrifty
from disclosa.llm.hashed import coder, held_out, scored, training_rows

BITS, DIM, WIDTHS, FILTERS = 18, 8, (1, 2, 3), 6
#: Rows and words of a learner, about; one learner passes EPOCHS times over its rows, several once in each of ROUNDS.
ROWS, WORDS, EPOCHS, ROUNDS = 8000, 8_000_000, 5, 3
#: Words of a batch, about; of a longer text only the windows that won are held beside its hashes.
BATCH_WORDS = 1 << 17
#: Parts in which learners' tables are averaged.
PARTS = 64
MODULUS, HELD = 5, 0
#: One in so many labelled rows calibrates and does not train; rows of a language that get it a threshold of its own.
CALIBRATE, FEW = 5, 40
#: Calibration counts scores in so many steps; 0.02, 0.5 and 0.98 are steps.
STEPS = 5000
#: Share of a language's clean rows that its threshold may flag.
FALSE_RATE = 0.005
#: Words responded to at once; a longer text is taken in overlapping pieces.
PIECE = 8192

def fresh() -> Callable[[str | None], np.ndarray]:
    """A function from a text to the hashes of its words; what it keeps of words goes with it."""
    return coder(r"\w+", lower=True)


words = fresh()


def places(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = (1 << BITS) - 1
    return codes & mask, (codes >> BITS) & mask


@dataclass
class Model:
    table: np.ndarray
    kernels: list[np.ndarray]  # width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    squares: np.ndarray | None = None  # of the table's gradients; training only

    def copy(self) -> Model:
        """The same in double precision, in arrays of its own, to be trained on."""
        wide = lambda x: x.astype(np.float64)
        return replace(self, table=wide(self.table), kernels=[wide(k) for k in self.kernels], bias=wide(self.bias), out=wide(self.out), squares=wide(self.squares))

    def project(self) -> list[np.ndarray]:
        """For each width and offset what a table row adds to the filters' responses."""
        return [np.concatenate([self.table @ k[j] for j in range(len(k))], axis=1) for k in self.kernels]

    def pooled(self, codes: np.ndarray, projected: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(largest response, where) of every filter over a text; no window: response 0 at -1."""
        best, where = np.zeros(len(self.out)), np.full(len(self.out), -1)
        a, b = places(codes)
        for piece in range(0, len(codes), PIECE):
            for w, (width, p) in enumerate(zip(WIDTHS, projected, strict=True)):
                x, y = a[piece : piece + PIECE + width - 1], b[piece : piece + PIECE + width - 1]
                n = len(x) - width + 1
                if n <= 0:
                    continue
                r = sum(p[x[j : j + n], j * FILTERS : (j + 1) * FILTERS] + p[y[j : j + n], j * FILTERS : (j + 1) * FILTERS] for j in range(width))
                at = r.argmax(axis=0)
                got = r[at, np.arange(FILTERS)] + self.bias[w * FILTERS : (w + 1) * FILTERS]
                span = slice(w * FILTERS, (w + 1) * FILTERS)
                better = got > best[span]
                best[span] = np.where(better, got, best[span])
                where[span] = np.where(better, at + piece, where[span])
        return best, where

    def score(self, codes: np.ndarray, projected: list[np.ndarray]) -> float:
        z = self.pooled(codes, projected)[0] @ self.out + self.out_bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def untrained(seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    n_out = FILTERS * len(WIDTHS)
    return Model(
        np.zeros((1 << BITS, DIM)),
        [rng.normal(0, 0.5, (w, DIM, FILTERS)) for w in WIDTHS],
        np.full(n_out, 0.02),
        np.abs(rng.normal(0.5, 0.1, n_out)) * np.where(np.arange(n_out) % FILTERS < FILTERS * 2 // 3, 1, -1),
        0.0,
        squares=np.zeros((1 << BITS, 1)),
    )


def silent() -> Model:
    """What is used where labels teach nothing: every score is 0."""
    model = untrained()
    model.out[:], model.out_bias, model.squares = 0.0, -30.0, None
    return model


def batches(order: np.ndarray, lengths: np.ndarray, batch: int) -> Iterator[np.ndarray]:
    """order in pieces of at most `batch` rows and about BATCH_WORDS words; a longer text is a batch of its own."""
    at = 0
    while at < len(order):
        n = int(np.searchsorted(np.cumsum(lengths[order[at : at + batch]]), BATCH_WORDS, side="right"))
        yield order[at : at + max(1, n)]
        at += max(1, n)


def train(model: Model, texts: list[np.ndarray], y: np.ndarray, mean: float, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 5) -> Model:
    """model after Adam on the logistic loss; only the windows that won the pooling get gradients. mean: share of label 1; classes count equally."""
    rng = np.random.default_rng(seed)
    n_out = FILTERS * len(WIDTHS)
    weight = np.where(y == 1, 0.5 / mean, 0.5 / (1 - mean))
    dense = [*model.kernels, model.bias, model.out]
    m, v = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    squares = model.squares
    lengths = np.array([len(t) for t in texts])
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for rows in batches(order, lengths, batch):
            rows = rows[lengths[rows] > 0] if (lengths[rows] > 0).any() else rows[:0]
            if not len(rows):
                continue
            long = len(rows) == 1 and lengths[rows[0]] > BATCH_WORDS
            if long:  # the words of each filter's winning window, one filter after the other
                top, won = model.pooled(texts[rows[0]], model.project())
                codes = texts[rows[0]][np.minimum(np.maximum(won, 0)[:, None] + np.arange(max(WIDTHS)), lengths[rows[0]] - 1)].ravel()
            else:
                codes = np.concatenate([texts[r] for r in rows])
            starts = np.cumsum(lengths[rows]) - lengths[rows]
            used, where_used = np.unique(np.concatenate(places(codes)), return_inverse=True)
            a, b = where_used[: len(where_used) // 2], where_used[len(where_used) // 2 :]
            small = model.table[used]
            best, at = np.zeros((len(rows), n_out)), np.full((len(rows), n_out), -1)
            if long:
                best[0], at[0] = top, np.where(won >= 0, np.arange(n_out) * max(WIDTHS), -1)
            for w, width in enumerate(WIDTHS):
                span = slice(w * FILTERS, (w + 1) * FILTERS)
                n = len(a) - width + 1
                if n <= 0 or long:
                    continue
                r = sum((p := small @ model.kernels[w][j])[a[j : j + n]] + p[b[j : j + n]] for j in range(width))
                for x, (s, size) in enumerate(zip(starts, lengths[rows], strict=True)):
                    if size >= width:
                        top = r[s : s + size - width + 1].argmax(axis=0)
                        got = r[s + top, np.arange(FILTERS)] + model.bias[span]
                        best[x, span], at[x, span] = np.maximum(got, 0), np.where(got > 0, s + top, -1)
            z = best @ model.out + model.out_bias
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * weight[rows] / len(rows)
            grads = [np.zeros_like(p) for p in dense]
            g_table, g_bias = np.zeros((len(used), DIM)), g.sum()
            grads[-1] += g @ best
            passed = np.where(at >= 0, g[:, None] * model.out, 0.0)
            grads[-2] += passed.sum(axis=0)
            for w, width in enumerate(WIDTHS):
                span = slice(w * FILTERS, (w + 1) * FILTERS)
                for j in range(width):
                    i = np.minimum(np.maximum(at[:, span], 0) + j, len(a) - 1)
                    d = passed[:, span]
                    grads[w][j] += np.einsum("rf,rfd->df", d, small[a[i]] + small[b[i]])
                    step_in = d[:, :, None] * model.kernels[w][j].T
                    np.add.at(g_table, a[i], step_in)
                    np.add.at(g_table, b[i], step_in)
            step += 1
            for p, g, mm, vv in zip(dense, grads, m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                p -= rate / 2 * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
            squares[used] += (g_table**2).mean(axis=1, keepdims=True)
            model.table[used] -= rate * 5 * g_table / (np.sqrt(squares[used]) + 1e-6)
            model.out_bias -= rate * g_bias
    return model


def parts(model: Model, before: np.ndarray, rows: int) -> list[bytes]:
    """A learner's model in PARTS parts of its table, with what it met since `before`, and one of the rest."""
    cut = lambda x: np.split(x.astype(np.float32), PARTS)
    table = [pickle.dumps(x) for x in zip(cut(model.table), cut(model.squares), np.split(model.squares > before, PARTS), strict=True)]
    return [*table, pickle.dumps((rows, [*model.kernels, model.bias, model.out, np.float64(model.out_bias)]))]


def average(part: int, held: list[bytes]) -> bytes:
    """One part of the learners' models, averaged: an embedding over the learners that met it, the rest by rows."""
    got = [pickle.loads(x) for x in held]
    if part == PARTS:
        n = sum(rows for rows, _ in got)
        return pickle.dumps([sum(x[k] * (rows / n) for rows, x in got) for k in range(len(got[0][1]))])
    met = sum(m.astype(np.float32) for _, _, m in got)
    out = [np.where(met > 0, sum(x[k] * x[2] for x in got) / np.maximum(met, 1), got[0][k]) for k in (0, 1)]
    return pickle.dumps(out)


def put_together(found: dict[int, bytes]) -> Model:
    held = [pickle.loads(found[k]) for k in range(PARTS + 1)]
    *kernels, bias, out, out_bias = held[-1]
    table, squares = (np.concatenate([x[k] for x in held[:-1]]) for k in (0, 1))
    return Model(table, kernels, bias, out, float(out_bias), squares=squares)


def learned(rows: DataFrame, model: Model, mean: float, learners: int, epochs: int, turn: int) -> Model:
    """model after `epochs` over rows(doc_id, y, codes): one learner for each share of them by hash, their models averaged.

    Shares and their order depend on the ids alone. A learner holds the hashes of its own rows.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(replace(model, table=model.table.astype(np.float32), squares=model.squares.astype(np.float32)))  # of fixed size

    def learner(who: int, group: Iterator[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        _, y, texts = zip(*group, strict=True)
        made = parts(train(shipped.value.copy(), list(texts), np.array(y, dtype=np.float64), mean, epochs, seed=5 + turn), shipped.value.squares, len(y))
        return pa.RecordBatch.from_arrays([pa.array([who] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()), pa.array(made, pa.binary())], names=["who", "part", "model"])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = ((w, y, np.asarray(c.values, dtype=np.int64)) for x in found for w, y, c in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), x.column(2), strict=True))
        for who, group in groupby(each, key=lambda x: x[0]):
            yield learner(who, group)  # whose rows and model are gone before the next one's come
            give_back()

    def join(held: pa.Table) -> pa.Table:
        held = held.sort_by("who")
        part = held.column("part")[0].as_py()
        return pa.table({"part": pa.array([part], pa.int32()), "model": pa.array([average(part, held.column("model").to_pylist())], pa.binary())})

    shares = rows.select(F.pmod(F.xxhash64("doc_id", F.lit("learner")), F.lit(learners)).cast("int").alias("who"), "y", "codes", F.xxhash64("doc_id").alias("_order"), "doc_id")
    dealt = shares.repartition(4 * learners, "who").sortWithinPartitions("who", "_order", "doc_id").select("who", "y", "codes")
    found = dealt.mapInArrow(thrifty(run), "who int, part int, model binary").groupBy("part").applyInArrow(join, "part int, model binary").collect()
    shipped.unpersist()
    return put_together({r.part: r.model for r in found})




def threshold(scores: np.ndarray, y: np.ndarray, counts: np.ndarray | None = None) -> float:
    """Of the thresholds that flag at most FALSE_RATE of the clean rows the one with most right verdicts, nearest to 0.5 on ties."""
    if not len(y) or y.min() == y.max():
        return 0.5
    counts = np.ones(len(y), dtype=np.int64) if counts is None else counts
    edges = np.unique(scores)
    options = np.unique(np.clip(np.concatenate([[0.5, 0.98], (edges[1:] + edges[:-1]) / 2]), 0.02, 0.98))
    below, total = [], []
    for label in (0, 1):
        order = np.argsort(scores[y == label])
        sums = np.concatenate([[0], np.cumsum(counts[y == label][order])])
        below.append(sums[np.searchsorted(scores[y == label][order], options)])
        total.append(sums[-1])
    false = total[0] - below[0]
    right = total[0] - false + total[1] - below[1]
    right[false > max(1, FALSE_RATE * total[0])] = -1
    return float(min(options[right == right.max()], key=lambda t: abs(t - 0.5)))


def calibrate(scores: np.ndarray, y: np.ndarray, langs: list, counts: np.ndarray | None = None) -> dict[str, float]:
    """A threshold for each language with FEW rows or more and both classes; "" has that of all rows. counts: rows of each entry, 1 if not given."""
    counts = np.ones(len(y), dtype=np.int64) if counts is None else counts
    out = {"": threshold(scores, y, counts)}
    of = np.array([x or "" for x in langs], dtype=object)
    for lang in sorted({x for x in langs if x}):
        at = of == lang
        if counts[at].sum() >= FEW and len(np.unique(y[at])) == 2:
            out[lang] = threshold(scores[at], y[at], counts[at])
    return out


def coded_rows(rows: DataFrame) -> DataFrame:
    """doc_id, y, lang, codes (the bits of a word's hash that places() reads), apart (whether it calibrates) of rows(doc_id, y, lang, text)."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    bits = (1 << 2 * BITS) - 1

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = fresh()
        for batch in pieces(found, 3):
            codes = pa.array([code(t.as_py()) & bits for t in batch.column(3)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], codes], names=["doc_id", "y", "lang", "codes"])

    made = rows.select("doc_id", "y", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(thrifty(run), f"doc_id {kind}, y int, lang string, codes array<long>")
    return made.withColumn("apart", F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(CALIBRATE)) == 0)


def counted_scores(rows: DataFrame, model: Model) -> DataFrame:
    """lang, y, step, n: rows(y, lang, codes) of each step of the score."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shipped.value
        projected = held.project()
        for batch in found:
            score = np.array([held.score(np.asarray(c.values, dtype=np.int64), projected) for c in batch.column(2)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((score * STEPS).astype(np.int32))], names=["lang", "y", "step"])

    return rows.select("lang", "y", "codes").mapInArrow(thrifty(run), "lang string, y int, step int").groupBy("lang", "y", "step").agg(F.count("*").alias("n"))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learns on all labelled rows outside the held-out fold: those set apart give the thresholds, the others train."""
    spark = documents.sparkSession
    small_batches(spark)
    coded = materialise(coded_rows(training_rows(documents, labels, "toxic", (MODULUS, HELD), None)), "coded")
    free_shuffles(spark)
    train_on = coded.where("not apart")
    n, toxic, said = train_on.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()
    if not 0 < toxic < n:
        discard(coded)
        return silent()
    learners = max(1, -(-n // ROWS), -(-said // WORDS))
    model = untrained()
    for turn in range(1 if learners == 1 else ROUNDS):
        model = learned(train_on, model, toxic / n, learners, EPOCHS if learners == 1 else 1, turn)
        free_shuffles(spark)
    model.table, model.kernels, model.squares = model.table.astype(np.float32), [k.astype(np.float32) for k in model.kernels], None
    found = counted_scores(coded.where("apart"), model).orderBy("lang", "y", "step").toArrow()
    steps, y, n = (found.column(c).to_numpy() for c in ("step", "y", "n"))
    model.thresholds = calibrate((steps + 0.5) / STEPS, y, found.column("lang").to_pylist(), n)
    discard(coded)
    return model


def bound(model: Model) -> Column:
    """The threshold of a row's lang."""
    whole = F.lit(model.thresholds.get("", 0.5))
    return F.coalesce(*(F.when(F.col("lang") == k, F.lit(t)) for k, t in model.thresholds.items() if k), whole)


def scored_rows(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """doc_id, the columns in keep (text may be one of them) and score of every row, without a join."""
    small_batches(documents.sparkSession)
    shipped, key = documents.sparkSession.sparkContext.broadcast(model), hashlib.sha256(pickle.dumps(model)).hexdigest()  # the table has a fixed size

    def score(texts: list[str | None]) -> np.ndarray:
        projected, code = kept_by_worker(key, lambda: (shipped.value.project(), fresh()))
        return np.array([shipped.value.score(code(t), projected) for t in texts], dtype=np.float64)

    return scored(documents, "score", score, keep)


def score_table(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, score, predicted (score >= 0.5) and flagged (score >= the language's threshold) of every row."""
    named = documents if "lang" in documents.columns else documents.withColumn("lang", F.lit(None).cast("string"))
    found = scored_rows(named, model, ["lang"])
    return found.withColumns({"predicted": (F.col("score") >= 0.5).cast("int"), "flagged": F.col("score") >= bound(model), "held_out": held_out(MODULUS, HELD)})
