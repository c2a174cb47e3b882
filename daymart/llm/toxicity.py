"""Convolutional text classifier over hashed word embeddings, trained in numpy.

Words are hashed into two embedding tables whose rows are added, so two words only share an embedding when both
hashes meet. Filters of several widths run over the word sequence, each filter's largest response over the whole
text goes through a rectifier into a logistic output. Max pooling lets a few words in a very long text decide, so
texts are read whole, in blocks of words that only keep the running maximum.

Training reads every labelled row given. Their words are hashed once and dealt to blocks of about ``BLOCK_BYTES`` of
text by a hash of id and words. In each of a few rounds every block goes on from the common model by itself, over all
its rows, and the steps of the blocks are averaged, parameter by parameter, over the blocks that moved it; only the
model, whose size is fixed, goes through the driver. One row in five, by its id, is kept for calibration: all of these
are scored, and their outputs are counted in ``BINS`` bins by label and language. The logistic output is rescaled so
that 0.7 is the cut that separates the calibration rows best, and each language gets a cut of its own on the same scale,
drawn towards the common one where it has few rows. Language chooses a threshold, it is no input of a score.

Null and empty texts have no words and get the score of a text without evidence. Repeated rows get equal scores; rows
of unknown language use the common cut; other columns are not read. A labelled row that is repeated is learnt from once,
with its count as weight. Without labelled rows of both classes every score is 0.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import lower_words, materialize, parts

ROWS, DIM, WIDTHS, FILTERS, CUT = 1 << 17, 8, (1, 2, 3), 8, 0.7
BLOCK, BLOCK_BYTES, ROUNDS, BINS = 8192, 24 << 20, 3, 4096
STRIP = b".,;:!?\"'()[]{}|*#$%&_-<>"


def hashed(text: str | None) -> np.ndarray:
    """Two table rows per word of a text, (words, 2)."""
    out = [zlib.crc32(w) << 32 | zlib.adler32(w) * 2654435761 % (1 << 32)
           for w in (x.strip(STRIP) for x in lower_words(text)) if w]
    h = np.array(out, np.uint64)
    return np.stack([h >> np.uint64(32), h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)], 1).astype(np.int64) % ROWS


@dataclass
class Model:
    """Filter responses are linear, so a word's part of each filter position is stored per table row: ``parts`` is
    (2, ROWS, positions, FILTERS)."""

    embed: np.ndarray
    filters: dict
    bias: dict
    out: np.ndarray
    out_bias: float
    scale: tuple = (1.0, 0.0)
    cuts: dict = field(default_factory=dict)

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        """Largest response of every filter over a text's words."""
        best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
        reach = max(WIDTHS) - 1
        for at in range(0, max(1, len(ids)), BLOCK):
            x = self.words(ids[at:at + BLOCK + reach])
            for k, width in enumerate(WIDTHS):
                y = self.respond(x, width)
                if len(y):
                    best[k] = np.maximum(best[k], y.max(0))
        return np.where(np.isfinite(best), best, 0).ravel()

    def words(self, ids: np.ndarray) -> np.ndarray:
        return self.embed[0, ids[:, 0]] + self.embed[1, ids[:, 1]]

    def respond(self, x: np.ndarray, width: int) -> np.ndarray:
        n = len(x) - width + 1
        if n <= 0:
            return np.empty((0, FILTERS), np.float32)
        w = self.filters[width]
        y = x[:n] @ w[0]
        for j in range(1, width):
            y += x[j:j + n] @ w[j]
        return y + self.bias[width]

    def raw(self, ids: np.ndarray) -> float:
        return float(np.maximum(self.pooled(ids), 0) @ self.out + self.out_bias)

    def score(self, ids: np.ndarray) -> float:
        a, b = self.scale
        return float(1 / (1 + np.exp(-np.clip(a * self.raw(ids) + b, -30, 30))))


def _new(rng) -> Model:
    size = len(WIDTHS) * FILTERS
    return Model(rng.normal(0, 0.01, (2, ROWS, DIM)).astype(np.float32),
                 {w: rng.normal(0, 1 / np.sqrt(w * DIM), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS},
                 {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
                 rng.uniform(0.2, 0.5, size).astype(np.float32), -1.0)


def start(seed: int = 11) -> tuple[Model, dict]:
    """A new model and its AdaGrad sums."""
    model = _new(np.random.default_rng(seed))
    seen = {"e": np.full((2, ROWS, 1), 1e-2, np.float32), "o": np.full(len(model.out), 1e-2, np.float32), "b": 1e-2}
    return model, seen | {w: np.full_like(model.filters[w], 1e-2) for w in WIDTHS}


def fit(model: Model, seen: dict, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng, rate: float = 0.12,
        batch: int = 32, steps: int = 600) -> None:
    """Logistic loss by AdaGrad, from the model and sums given and in place: whole passes, at least ``steps`` batches;
    only the words that win a filter's pooling receive a gradient."""
    epochs = math.ceil(steps * batch / len(texts)) if len(texts) < steps * batch else 1
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            step = {w: np.zeros_like(model.filters[w]) for w in WIDTHS}
            out_step, bias_step, words = np.zeros_like(model.out), 0.0, []
            for i in order[at:at + batch]:
                ids = texts[i]
                if len(ids) == 0:
                    continue
                x = model.words(ids)
                pooled, where = np.zeros((len(WIDTHS), FILTERS), np.float32), {}
                for k, w in enumerate(WIDTHS):
                    r = model.respond(x, w)
                    if len(r):
                        where[w] = r.argmax(0)
                        pooled[k] = r[where[w], np.arange(FILTERS)]
                h = np.maximum(pooled.ravel(), 0)
                p = 1 / (1 + np.exp(-np.clip(h @ model.out + model.out_bias, -30, 30)))
                g = float((p - y[i]) * weight[i])
                out_step += g * h
                bias_step += g
                back = (g * model.out * (pooled.ravel() > 0)).reshape(pooled.shape)
                for k, w in enumerate(WIDTHS):
                    if w not in where:
                        continue
                    for f in np.flatnonzero(back[k]):
                        at_word = where[w][f]
                        for j in range(w):
                            step[w][j, :, f] += back[k, f] * x[at_word + j]
                            words.append((ids[at_word + j], back[k, f] * model.filters[w][j, :, f]))
            n = len(order[at:at + batch])
            for w in WIDTHS:
                step[w] /= n
                seen[w] += step[w] ** 2
                model.filters[w] -= rate * step[w] / np.sqrt(seen[w])
            out_step /= n
            seen["o"] += out_step ** 2
            model.out -= rate * out_step / np.sqrt(seen["o"])
            seen["b"] += (bias_step / n) ** 2
            model.out_bias -= rate * bias_step / n / np.sqrt(seen["b"])
            if words:
                rows, grads = np.array([r for r, _ in words]), np.array([d for _, d in words], np.float32) / n
                for t in (0, 1):
                    uniq, place = np.unique(rows[:, t], return_inverse=True)
                    total = np.zeros((len(uniq), DIM), np.float32)
                    np.add.at(total, place, grads)
                    seen["e"][t, uniq] += (total ** 2).mean(1, keepdims=True)
                    model.embed[t, uniq] -= rate * total / np.sqrt(seen["e"][t, uniq])


def small(model: Model, seen: dict) -> np.ndarray:
    """All parameters but the embeddings, and their sums, in rows of DIM numbers."""
    flat = [*(model.filters[w].ravel() for w in WIDTHS), model.out, [model.out_bias],
            *(seen[w].ravel() for w in WIDTHS), seen["o"], [seen["b"]]]
    flat = np.concatenate(flat).astype(np.float32)
    return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)


def take_small(model: Model, seen: dict, rows: np.ndarray) -> None:
    flat, at = rows.ravel(), 0
    for filters, out in ((model.filters, "out"), (seen, "o")):
        for w in WIDTHS:
            size = model.filters[w].size
            filters[w], at = flat[at:at + size].reshape(model.filters[w].shape).copy(), at + size
        values, last = flat[at:at + len(model.out)].copy(), float(flat[at + len(model.out)])
        at += len(values) + 1
        if out == "out":
            model.out, model.out_bias = values, last
        else:
            seen["o"], seen["b"] = values, last


def best_cut(bins, negatives: float) -> float:
    """The value between two bins at which F1 is best when a clean row stands for ``negatives`` clean rows; the middle of
    the gap around it. ``bins``: (least, largest, toxic rows, clean rows) of each, from the largest outputs down."""
    low, high, toxic, clean = bins
    hit = np.cumsum(toxic)
    f1 = 2 * hit / (hit + np.cumsum(clean) * negatives + max(1, toxic.sum()))
    k = int(f1.argmax())
    return float((low[k] + high[k + 1]) / 2 if k + 1 < len(low) else low[k] - 1)


def _merged(counts) -> tuple:
    """Bins of a pandas frame of counts, over its languages."""
    got = counts.groupby("bin").agg(low=("low", "min"), high=("high", "max"), toxic=("toxic", "sum"),
                                    clean=("clean", "sum")).sort_index(ascending=False)
    return tuple(got[c].to_numpy(float) for c in ("low", "high", "toxic", "clean"))


def _median(bins, which: int) -> float:
    n = np.cumsum(bins[which])
    k = int(np.searchsorted(n, n[-1] / 2))
    return (bins[0][k] + bins[1][k]) / 2


def calibrate(model: Model, counts, prior: float = 40.0) -> Model:
    """Scale outputs so that CUT is the best common cut; cuts by language, on the scale of the scores. ``counts``: by
    lang and bin, the least and largest output and the rows of each label."""
    bins = _merged(counts)
    negatives = (bins[2].sum() / bins[3].sum()) ** 0.5  # between balanced and as they occur
    common = best_cut(bins, negatives)
    spread = max(1e-3, (_median(bins, 2) - _median(bins, 3)) / 2)
    a = min(4.0 / spread, 20.0 / max(1e-3, bins[1].max() - common, common - bins[0].min()))
    model.scale = (float(a), float(np.log(CUT / (1 - CUT)) - a * common))
    for lang, mine in counts[counts["lang"].notna()].groupby("lang"):
        own = _merged(mine)
        if 0 < own[2].sum() and 0 < own[3].sum():
            few = prior / (prior + own[2].sum())
            cut = few * common + (1 - few) * best_cut(own, negatives)
            model.cuts[lang] = float(1 / (1 + np.exp(-np.clip(a * cut + model.scale[1], -30, 30))))
    return model


KNOWN = "_id string, _toxic int, _lang string, _hold boolean, _words binary"
_STEP = ["row long", "seen float", *(f"d{k} float" for k in range(DIM))]


def _hashed_rows(found):
    for batch in found:
        words = [hashed(t).astype(np.int64) for t in batch.column("_text").to_pylist()]
        packed = pa.array([(x[:, 0] | x[:, 1] << 17).tobytes() for x in words], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_toxic", "_lang", "_hold")), packed],
                                         names=["_id", "_toxic", "_lang", "_hold", "_words"])


def _unpacked(words: bytes) -> np.ndarray:
    x = np.frombuffer(words, np.int64)
    return np.stack([x & ROWS - 1, x >> 17], 1)


def known_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Every labelled row with its hashed words, as a table sorted by block."""
    known = labels.where("toxic in (0, 1)").groupBy(labels[id_col].alias("_id")) \
        .agg(F.max("toxic").cast("int").alias("_toxic"))
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"),
                       docs[lang_col].cast("string").alias("_lang"))
    size = rows.select("_id", F.octet_length("_text").alias("_size")).join(known.select("_id"), "_id") \
        .agg(F.sum("_size").alias("b")).first()["b"]
    blocks = parts(int(size or 0), BLOCK_BYTES)
    name = F.col("_id").cast("string")
    # a merge at any size: labels outgrow a broadcast, and the texts move once
    found = rows.join(known.hint("merge"), "_id").select(name.alias("_id"), "_toxic", "_lang",
                                                       (F.pmod(F.crc32(name), F.lit(5)) == 0).alias("_hold"), "_text") \
        .mapInArrow(_hashed_rows, KNOWN) \
        .withColumn("_block", F.pmod(F.xxhash64("_id", "_words", F.lit(5)), F.lit(blocks)))
    return materialize(found.repartition(blocks, "_block").sortWithinPartitions("_block", "_id", "_words"), "toxicity-known")


def block_rows(found):
    """(block, texts, labels, times each occurs) of every block in sorted rows (_block, _id, _toxic, _words)."""
    block, last, texts, y, times = None, None, [], [], []
    for batch in found:
        for b, i, toxic, words in zip(*(batch.column(c).to_pylist() for c in ("_block", "_id", "_toxic", "_words"))):
            if b != block:
                if texts:
                    yield block, texts, np.array(y, np.float32), np.array(times, np.float32)
                block, last, texts, y, times = b, None, [], [], []
            if (i, words) == last:
                times[-1] += 1
                continue
            last = (i, words)
            texts.append(_unpacked(words))
            y.append(toxic)
            times.append(1)
    if texts:
        yield block, texts, np.array(y, np.float32), np.array(times, np.float32)


def average_steps(rows: DataFrame, model: Model, seen: dict, each: dict, turn: int) -> tuple[Model, dict]:
    """One round: every block of ``rows`` goes on from the model; the mean of the steps that moved a parameter."""
    sent = rows.sparkSession.sparkContext.broadcast((model, seen))

    def run(found):
        for block, texts, y, times in block_rows(found):
            model, seen = sent.value
            mine = Model(model.embed.copy(), {w: x.copy() for w, x in model.filters.items()}, dict(model.bias),
                         model.out.copy(), model.out_bias)
            sums = {k: x.copy() if isinstance(x, np.ndarray) else x for k, x in seen.items()}
            weight = times * np.where(y > 0, each[1], each[0])
            fit(mine, sums, texts, y, weight, np.random.default_rng([turn, block]), steps=200)
            moved = np.flatnonzero((mine.embed != model.embed).any(2) | (sums["e"] != seen["e"])[:, :, 0])
            step = (mine.embed - model.embed).reshape(-1, DIM)[moved]
            more = (sums["e"] - seen["e"]).ravel()[moved]
            rest = small(mine, sums) - small(model, seen)
            row = np.concatenate([moved, 2 * ROWS + np.arange(len(rest))])
            step, more = np.concatenate([step, rest]), np.concatenate([more, np.zeros(len(rest), np.float32)])
            for at in range(0, len(row), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(row[part]), pa.array(more[part]),
                                                  *(pa.array(step[part, k]) for k in range(DIM))],
                                                 names=[x.split()[0] for x in _STEP])

    wide = [x.split()[0] for x in _STEP[1:]]
    got = rows.select("_block", "_id", "_toxic", "_words").mapInArrow(run, ", ".join(_STEP)) \
        .groupBy("row").agg(*(F.avg(c).cast("float").alias(c) for c in wide)).toArrow()
    sent.destroy()
    row = got.column("row").to_numpy()
    own = row < 2 * ROWS
    rest = small(model, seen)
    for k, name in enumerate(wide[1:]):
        step = got.column(name).to_numpy()
        model.embed.reshape(-1, DIM)[row[own], k] += step[own]
        rest[row[~own] - 2 * ROWS, k] += step[~own]
    seen["e"].reshape(-1)[row[own]] += got.column("seen").to_numpy()[own]
    take_small(model, seen, rest)
    return model, seen


def output_counts(rows: DataFrame, model: Model):
    """The model's outputs of all rows, counted by language and bin."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(found):
        for batch in found:
            raw = [sent.value.raw(_unpacked(w)) for w in batch.column("_words").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_lang"), batch.column("_toxic"), pa.array(raw, pa.float64())],
                                             names=["lang", "toxic", "raw"])

    raw = materialize(rows.select("_lang", "_toxic", "_words").mapInArrow(run, "lang string, toxic int, raw double"),
                      "toxicity-outputs")
    sent.destroy()
    low, high = raw.agg(F.min("raw"), F.max("raw")).first()
    at = F.least(F.floor((F.col("raw") - low) * (BINS / max(high - low, 1e-9))), F.lit(BINS - 1))
    return raw.groupBy("lang", at.alias("bin")).agg(
        F.min("raw").alias("low"), F.max("raw").alias("high"), F.sum("toxic").alias("toxic"),
        F.sum(1 - F.col("toxic")).alias("clean")).toPandas()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rounds: int = ROUNDS) -> Model | None:
    """Fit and calibrate on all labelled rows given (the caller leaves held-out rows away)."""
    known = known_rows(docs, labels, id_col, text_col, lang_col)
    total = {(r["_hold"], r["_toxic"]): r["count"] for r in known.groupBy("_hold", "_toxic").count().collect()}
    have = {hold: [total.get((hold, label), 0) for label in (0, 1)] for hold in (False, True)}
    if not all(have[False]):
        return None
    each = {label: 0.5 * sum(have[False]) / n for label, n in enumerate(have[False])}
    model, seen = start()
    learnt = known.where("not _hold")
    for turn in range(rounds):
        model, seen = average_steps(learnt, model, seen, each, turn)
    return calibrate(model, output_counts(known.where("_hold") if all(have[True]) else learnt, model))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """All rows and columns of ``docs`` with toxic_score and toxic_cut (the threshold of the row's language).

    One narrow map over id and text; the model, of fixed size, is broadcast."""
    if model is None:
        return docs.withColumns({"toxic_score": F.lit(0.0), "toxic_cut": F.lit(CUT)})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts):
        m = sent.value
        return texts.map(lambda t: m.score(hashed(t)))

    cuts = F.create_map([F.lit(x) for pair in model.cuts.items() for x in pair]) if model.cuts else None
    cut = F.lit(CUT) if cuts is None else F.coalesce(F.try_element_at(cuts, docs[lang_col].cast("string")), F.lit(CUT))
    return docs.withColumns({"toxic_score": scored(docs[text_col].cast("string")), "toxic_cut": cut})
