"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its byte n-grams of 2 to 4 (letters lower-cased,
all else a space, no n-gram across a space), hashed into ``BUCKETS``.  Embeddings and the
softmax are trained together by stochastic gradient descent in numpy on a bounded sample:
about ``SAMPLE_PER_LANGUAGE`` rows a language by hash of the id.  Only the sampled rows'
n-gram counts, at most ``BUCKETS`` numbers each, reach the driver.  At prediction embedding and
softmax are one table of ``BUCKETS x languages``, so every whole text is counted once.

A softmax says which known language is likeliest, not whether any is.  So a text is also
held against its language's n-grams: how far its mean log-probability lies below that language's
usual one, in standard deviations for a text of its length (``fit``).  A fifth of the sample, never
trained on, calibrates both: rows of a known language, against rows that are none - each language
in turn measured by the others, and texts whose letters were shuffled.  A text is rejected if its score or
its fit is below its threshold, or if it has no letter.

Null texts and texts without a letter are ``und`` with score 0; so is every text if there
is nothing to learn from, and then only those without a letter are rejected.  Rows with a null id
are predicted but never learned from.  A language none of whose sampled rows has an n-gram is not learned.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitarium.llm.arrow import flat_texts, map_texts

BUCKETS = 1 << 13
ORDERS = (2, 3, 4)
SAMPLE_PER_LANGUAGE = 300
DIMENSIONS = 16
EPOCHS = 12
RATE = 4.0
#: Share of right calibration rows that either threshold may cost, and the highest threshold for scores.
REJECT_RIGHT = 0.002
MAX_THRESHOLD = 0.5
#: Where the threshold for the fit lies between the known rows' low end (0) and the unknown rows' high end (1).
TOWARDS_UNKNOWN = 0.5
UNKNOWN_SHARE = 0.95
#: Weight of n-grams never seen in a language, and how many overlapping n-grams count as one observation.
UNSEEN, OVERLAPPING = 0.02, 6.0
#: Most languages of one model; more distinct labels are an error.
MAX_LANGUAGES = 1000
#: One sampled row in so many is held back for calibration.
HELD = 5
#: Share of each label spread over all languages, so that scores of separable languages stay short of 1.
SMOOTHING = 0.02
UNKNOWN = "und"
#: Bytes counted at a time.
PIECE = 1 << 20

FOLDS, HELD_OUT = 4, 2


def _normal(raw: np.ndarray) -> np.ndarray:
    """Lower-cased letters and multi-byte characters; everything else a space."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    out = table[raw]
    upper = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[:-1] == 0xC3) & (raw[1:] != 0x97)) + 1
    out[upper] += 32
    return out


def bag(raw: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in a whole text."""
    counts = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for at in range(0, len(raw), PIECE):
        # one byte before tells a capital's second byte, and the longest n-gram reaches over the end
        lead = min(at, 1)
        letters = _normal(raw[at - lead:at + PIECE + ORDERS[-1] - 1])[lead:].astype(np.uint32)
        space = letters == 32
        for n in ORDERS:
            starts = min(PIECE, len(raw) - at, len(letters) - n + 1)
            if starts <= 0:
                continue
            code = np.full(starts, n, np.uint32)
            for k in range(n):
                code = code * np.uint32(0x01000193) ^ letters[k:k + starts]
            inside = ~space[1:1 + starts] if n > 2 else ~(space[:starts] & space[1:1 + starts])
            for k in range(2, n - 1):
                inside &= ~space[k:k + starts]
            bucket = (code * np.uint32(0x9E3779B1) >> shift)[inside]
            counts += np.bincount(bucket, minlength=BUCKETS)
    return counts


@dataclass
class Model:
    """Languages, logits of each bucket, temperature; each language's n-grams and how its texts usually fit; thresholds."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    log_share: np.ndarray
    usual: np.ndarray
    spread: np.ndarray
    noise: np.ndarray
    least_fit: float

    def scores(self, bags: np.ndarray) -> np.ndarray:
        total = np.maximum(bags.sum(axis=1, keepdims=True), 1)
        return _softmax((bags @ self.table / total + self.bias) / self.temperature)

    def fits(self, bags: np.ndarray) -> np.ndarray:
        """Per text and language: how usual the text's n-grams are, in standard deviations; below zero is less."""
        total = np.maximum(bags.sum(axis=1, keepdims=True), 1)
        return (bags @ self.log_share / total - self.usual) / np.sqrt(self.spread + self.noise / total)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _dense(sparse: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    bags = np.zeros((len(sparse), BUCKETS), np.float32)
    for i, (buckets, counts) in enumerate(sparse):
        bags[i, buckets] = counts
    return bags


def train(languages: list[str], labels: np.ndarray, sparse: list[tuple[np.ndarray, np.ndarray]], held: np.ndarray,
          shuffled: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Fits on the rows that are not ``held``, then temperature and thresholds on those.

    ``shuffled`` are the n-grams of the held rows, their letters in random order.
    """
    rng = np.random.default_rng(20_261)
    rows = np.flatnonzero(~held)
    embed = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    weight, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    weight += rng.normal(0, 0.1, weight.shape)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for row in rng.permutation(rows):
            buckets, counts = sparse[row]
            share = counts / counts.sum()
            mean = share @ embed[buckets]
            gap = _softmax((mean @ weight + bias)[None])[0]
            gap -= SMOOTHING / len(languages)
            gap[labels[row]] -= 1 - SMOOTHING
            back = weight @ gap
            weight -= rate * 0.1 * np.outer(mean, gap)
            bias -= rate * 0.01 * gap
            embed[buckets] -= rate * share[:, None] * back
    shares = np.zeros((BUCKETS, len(languages)))
    for row in rows:
        buckets, counts = sparse[row]
        shares[buckets, labels[row]] += counts / counts.sum()
    shares = shares / np.maximum(shares.sum(axis=0), 1e-12) * (1 - UNSEEN) + UNSEEN / BUCKETS
    log_share = np.log(shares)
    noise = OVERLAPPING * ((shares * log_share ** 2).sum(axis=0) - (shares * log_share).sum(axis=0) ** 2)
    model = Model(languages, (embed @ weight).astype(np.float32), bias.astype(np.float32), 1.0, 0.0, log_share.astype(np.float32),
                  (shares * log_share).sum(axis=0), np.ones(len(languages)), noise, -np.inf)
    if held.any():
        _calibrate(model, _dense([sparse[i] for i in np.flatnonzero(held)]), labels[held], _dense(shuffled))
    return model


def _calibrate(model: Model, bags: np.ndarray, truth: np.ndarray, shuffled: np.ndarray) -> None:
    """Sets temperature, how texts usually fit, and both thresholds from rows that were not trained on."""
    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(np.maximum(model.scores(bags)[np.arange(len(bags)), truth], 1e-12)).sum()

    model.temperature = min((2.0 ** k for k in np.arange(0, 3.01, 0.25)), key=loss)
    mean_log = bags @ model.log_share / np.maximum(bags.sum(axis=1, keepdims=True), 1)
    for k in range(len(model.languages)):
        own = mean_log[truth == k, k]
        if len(own) > 1:
            # the middle and the middle two thirds: a few rows in another language do not widen them
            low, model.usual[k], high = np.quantile(own, (1 / 6, 0.5, 5 / 6))
            model.spread[k] = max((high - low) / 2, 1e-3) ** 2
    scores, fits = model.scores(bags), model.fits(bags)
    right = scores.argmax(axis=1) == truth
    if not right.any():
        return
    model.threshold = float(min(MAX_THRESHOLD, np.quantile(scores[right].max(axis=1), REJECT_RIGHT)))
    known = np.quantile(fits[right, truth[right]], REJECT_RIGHT)
    strange = [model.fits(shuffled)[np.arange(len(bags)), model.scores(shuffled).argmax(axis=1)]]
    if len(model.languages) > 1:  # each row as the likeliest of the languages that are not its own
        other = scores.copy()
        other[np.arange(len(bags)), truth] = -1
        strange.append(fits[np.arange(len(bags)), other.argmax(axis=1)])
    unknown = np.quantile(np.concatenate(strange), UNKNOWN_SHARE)
    model.least_fit = float(known - TOWARDS_UNKNOWN * max(0.0, known - unknown))


def learnable(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % FOLDS != HELD_OUT, F.lit(False))


def fit(df: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """A model of the languages named in ``lang``; None if no row can be learned from."""
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"),
                     F.col(f"`{lang}`").alias("lang")).filter(learnable("id") & F.col("lang").isNotNull())
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct labels in {lang}: that is no column of languages")
    counts = {r.lang: r.n for r in found}
    if not counts:
        return None
    # about ``sample`` rows of each language, by hash of the id; then at most twice as many in all
    wanted = F.create_map(*(F.lit(x) for name in sorted(counts) for x in (name, sample / counts[name])))
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter((share < wanted[F.col("lang")]) & F.col("text").isNotNull()).limit(2 * sample * len(counts))

    order = F.xxhash64("id", "text")
    chosen = chosen.select("lang", order.alias("order"), (F.pmod(order, F.lit(HELD)) == 0).alias("held"), "text")

    def step(texts: pa.Array) -> list:
        bags = ([], [])
        for text in texts.to_pylist():
            bags[0].append(_packed(text))
            bags[1].append(_packed(_shuffled(text)))
        return list(bags)

    # of the shuffled texts only those of held rows are needed
    got = map_texts(chosen, ["lang", "order", "held"], "text", [("bag", "binary"), ("other", "binary")], step)
    got = got.withColumn("other", F.when(F.col("held"), F.col("other"))).toArrow().sort_by([("lang", "ascending"), ("order", "ascending")])
    got = got.filter(pc.greater(pc.binary_length(got["bag"]), 0)) if len(got) else got
    if not len(got):
        return None
    names = got["lang"].to_pylist()
    languages, held = sorted(set(names)), np.array(got["held"].to_pylist(), bool)
    if held.all():
        held[:] = False
    return train(languages, np.array([languages.index(name) for name in names]), [_unpacked(b.as_py()) for b in got["bag"]], held,
                 [_unpacked(b.as_py()) for b in got["other"].filter(pa.array(held))])


def _packed(text: str) -> bytes:
    """A text's buckets and counts, small; empty without any."""
    counted = bag(np.frombuffer(text.encode(), np.uint8))
    used = np.flatnonzero(counted)
    return zlib.compress(used.astype("<u2").tobytes() + counted[used].astype("<u4").tobytes(), 1) if len(used) else b""


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(raw) if raw else b""
    n = len(raw) // 6
    return np.frombuffer(raw, "<u2", n), np.frombuffer(raw, "<u4", n, 2 * n).astype(np.float32)


def _shuffled(text: str) -> str:
    """The same letters in random order, spaces where they were."""
    letters = [c for c in text if not c.isspace()]
    mixed = iter(np.random.default_rng(len(text)).permutation(len(letters)).tolist())
    return "".join(c if c.isspace() else letters[next(mixed)] for c in text)


def _step(model: Model | None):
    def step(texts: pa.Array) -> list:
        size = len(texts)
        named = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if model is None:
            return [[UNKNOWN] * size, np.zeros(size), ~named]
        data, starts = flat_texts(texts)
        best, score, fit = np.zeros(size, int), np.zeros(size), np.full(size, -np.inf)
        for row in np.flatnonzero(named):
            counted = bag(data[starts[row]:starts[row + 1]])[None]
            scores = model.scores(counted)[0]
            best[row] = scores.argmax()
            score[row], fit[row] = scores[best[row]], model.fits(counted)[0, best[row]]
        names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, named)]
        return [names, score, ~named | (score < model.threshold) | (fit < model.least_fit)]

    return step


FIELDS = [("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")]


def predict(df: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``held_out``, ``lang_pred``, ``score`` and ``rejected``."""
    found = map_texts(df, [id_column], text, FIELDS, _step(model))
    held = F.coalesce(~learnable(id_column) & F.col(f"`{id_column}`").isNotNull(), F.lit(False))
    return found.select(f"`{id_column}`", held.alias("held_out"), "lang_pred", "score", "rejected")


def accepted(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows whose language is known well enough, with the columns they came with."""
    found = map_texts(df, df.columns, text, [("rejected", "boolean")], lambda texts: _step(model)(texts)[2:])
    found = found.toDF(*(f"c{i}" for i in range(len(df.columns))), "rejected")
    return found.filter(~F.col("rejected")).drop("rejected").toDF(*df.columns)
