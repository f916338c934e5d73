"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lowered, everything but letters separates words, and every run of two
to four symbols that does not cross a word's edge is a subword; edges count as a
symbol.  Subwords are hashed into buckets with an embedding each; the average
embedding of a text goes through a linear softmax.  The model is trained by
stochastic gradient descent in numpy on a bounded sample, its temperature is set
on a part that the training has not seen.

Only subwords seen in training count; a finer hash tells them from others.  The
share of a text's subwords that are known is its second score: texts of a
language, script or noise that was never learned have a low one.  A text is
rejected when either score is below what the part kept apart reaches; how many
foreign texts pass is estimated by leaving out one language after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import distinct_names, filtered
from .ngram_join import chunks
from .text_arrays import mix

BUCKETS = 1 << 14
#: Places of a subword's finer hash for each bucket: by these a subword counts as seen.
FINE = 64
DIMENSIONS = 16
ORDERS = (2, 3, 4)
#: Labelled rows a model is fitted on, shared evenly by the languages.
SAMPLE_ROWS = 2400
#: Languages a model can hold; a table with more labels is refused.
MAX_LANGUAGES = 1000
EPOCHS = 6
RATE = 0.8
#: Share of right answers that a rejection may cost, estimated on the calibration rows.
FALSE_REJECTS = 0.001
#: Short versions of each calibration text.
SHORT_DRAWS = 4
SLICE = 1 << 18
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point's lowered letter, or 0."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
    return table


def subwords(texts: list[str | None], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and hashes below ``buckets`` of all subwords, in slices of bounded size."""
    raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
    codes = np.frombuffer(b"\0\0\0\0".join([b"", *raw, b""]), dtype="<u4")  # an edge before, between and after
    number = np.repeat(np.arange(len(raw)), [len(r) // 4 + 1 for r in raw])
    shift = np.uint64(64 - (buckets - 1).bit_length())
    for begin in range(0, len(number), SLICE):
        end = min(begin + SLICE, len(number))
        letters = _letters()[codes[begin : end + max(ORDERS) - 1]]
        values = mix(letters.astype(np.uint64) + np.uint64(1))
        for n in ORDERS:
            m = min(end - begin, len(letters) - n + 1)
            if m <= 0:
                continue
            valid = (letters[:m] != 0) | (letters[n - 1 : n - 1 + m] != 0)
            key = values[:m] * np.uint64(n)
            for k in range(1, n):
                key = key * np.uint64(0x9E3779B97F4A7C15) + values[k : k + m]
                if k < n - 1:
                    valid &= letters[k : k + m] != 0
            at = np.flatnonzero(valid)
            yield number[begin + at], (mix(key[at]) >> shift).astype(np.int64)


@dataclass
class LanguageModel:
    """Languages, the score each bucket adds to each of them, the offsets, and what is accepted.

    ``seen`` holds a bit for each fine hash, ``threshold`` is the least
    probability and ``least_known`` the least share of known subwords;
    ``false_rejects`` and ``false_accepts`` are the shares of own texts
    rejected and of texts of a left-out language accepted, as calibrated.
    """

    languages: list[str]
    table: np.ndarray
    offset: np.ndarray
    threshold: float
    seen: np.ndarray
    least_known: float = 0.0
    false_rejects: float = 0.0
    false_accepts: float = 0.0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability and rejection of each text; without letters ``und``, 0 and rejected."""
        n, k = len(texts), len(self.languages)
        total, known, sums = np.zeros(n), np.zeros(n), np.zeros((n, max(k, 1)))
        for number, fine in subwords(texts, len(self.table) * FINE):
            total += np.bincount(number, minlength=n)
            told = (self.seen[fine >> 3] >> (fine & 7)) & 1 != 0
            number, bucket = number[told], fine[told] // FINE
            known += np.bincount(number, minlength=n)
            for c in range(k):
                sums[:, c] += np.bincount(number, weights=self.table[bucket, c], minlength=n)
        if not k:
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, dtype=bool)
        chances = softmax(sums / np.maximum(known, 1)[:, None] + self.offset)
        best = chances.argmax(axis=1)
        blank = total == 0
        score = np.where(blank, 0.0, np.clip(chances[np.arange(n), best], 0.0, 1.0))
        names = [UNKNOWN if empty else self.languages[b] for b, empty in zip(best, blank, strict=True)]
        strange = (known == 0) | (known < self.least_known * total)
        return names, score, strange | (score < self.threshold)


def nothing_learned() -> LanguageModel:
    return LanguageModel([], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 0.0, np.zeros(BUCKETS * FINE // 8, np.uint8))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


Example = tuple[np.ndarray, np.ndarray, int]  # fine hashes, their counts, language number


def _quantile(values: np.ndarray, share: float) -> float:
    """A bound that about ``share`` of the values lie below; a little under all of them where that is none."""
    values = np.sort(values)
    rank = int(share * (len(values) + 1))
    return float(values[rank] if rank else 0.9 * values[0]) if len(values) else 0.0


def train(examples: list[Example], languages: list[str], buckets: int = BUCKETS, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent; every fifth example is kept for calibration."""
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1.0, 1.0, (buckets, DIMENSIONS)) / DIMENSIONS
    weight, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    fit = [x for i, x in enumerate(examples) if i % 5] or examples
    held = [x for i, x in enumerate(examples) if not i % 5]
    owner = np.full(buckets * FINE, -1, dtype=np.int16)  # the language that has a subword; -1 none, -2 several
    for fine, _, y in fit:
        owner[fine] = np.where((owner[fine] == -1) | (owner[fine] == y), y, -2)
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            fine, counts, y = fit[i]
            ids = fine // FINE
            if rng.random() < 0.5:  # short texts must work as well
                counts = rng.multinomial(int(rng.integers(8, 200)), counts / counts.sum())
                ids, counts = ids[counts > 0], counts[counts > 0]
            share = counts / counts.sum()
            mean = share @ embedding[ids]
            error = softmax(mean @ weight + bias)
            error[y] -= 1.0
            rate = RATE * (1.0 - step / steps)
            back = weight @ error
            weight -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            np.subtract.at(embedding, ids, rate * share[:, None] * back * len(ids) ** 0.5)
            step += 1
    table = embedding @ weight
    seen = owner != -1
    logits, truth, shares, foreign = [], [], [], []
    for fine, counts, y in held or fit:  # whole, and cut down to a few words: those are where confidence goes wrong
        drawn = [rng.multinomial(int(rng.integers(4, 40)), counts / counts.sum()) for _ in range(SHORT_DRAWS)]
        own, others = seen[fine], seen[fine] & (owner[fine] != y)
        for c in [counts, *drawn]:
            share = c * own / max(1, (c * own).sum())
            logits.append(share @ table[fine // FINE] + bias)
            truth.append(y)
            shares.append((c * own).sum() / c.sum())
            foreign.append((c * others).sum() / c.sum())
    logits, truth, shares, foreign = map(np.array, (logits, truth, shares, foreign))
    rows = np.arange(len(truth))
    sharpness = min(
        np.geomspace(0.05, 20, 60), key=lambda s: -np.log(softmax(s * logits)[rows, truth] + 1e-12).mean()
    )
    chances = softmax(sharpness * logits)
    right = chances.argmax(axis=1) == truth
    threshold = _quantile(chances.max(axis=1)[right], FALSE_REJECTS / 2)
    least_known = _quantile(shares[right], FALSE_REJECTS / 2)
    return LanguageModel(
        languages, (sharpness * table).astype(np.float32), sharpness * bias, threshold,
        np.packbits(seen, bitorder="little"), least_known,
        float(((shares < least_known) | (chances.max(axis=1) < threshold)).mean()),
        float((foreign >= least_known).mean()) if len(languages) > 1 else 0.0,
    )


def remainder(doc_id: str = "doc_id") -> Column:
    """The fold of a document, 0 to 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def fit_languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """A model from ``text`` and non-null ``lang`` of documents outside fold 2.

    At most ``sample_rows`` rows are used, an even share a language, drawn by
    a hash of the id; each comes as counts of its distinct subwords.

    Null texts, texts without letters, null labels and null ids teach nothing;
    rows of equal id are rows of their own; other columns are ignored; without
    a usable row the model holds no language and rejects everything.
    """
    known = docs.where((remainder() != 2) & F.col("lang").isNotNull())
    counts = known.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted(r[0] for r in counts)
    if not languages:
        return nothing_learned()
    wanted = 1.2 * sample_rows / len(languages)
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r[0], min(1.0, wanted / r[1])).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            ids, sums = [], []
            for text in texts:
                fine, own = np.empty(0, np.int64), np.empty(0, np.int64)
                for _, more in subwords([text], BUCKETS * FINE):
                    fine, place = np.unique(np.concatenate([fine, more]), return_inverse=True)
                    own = np.bincount(place, weights=np.concatenate([own, np.ones(len(more), np.int64)])).astype(np.int64)
                ids.append(fine)
                sums.append(np.minimum(own, np.iinfo(np.int32).max))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array(ids, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int32())),
                ],
                names=["draw", "lang", "ids", "counts"],
            )

    rows = (
        known.where(draw < share).select(F.xxhash64("doc_id").alias("draw"), "lang", "text")
        .mapInArrow(counted, "draw long, lang string, ids array<int>, counts array<int>")
        .where(F.size("ids") > 0).orderBy("draw", "lang", "ids").limit(sample_rows).toArrow()
    )
    number = {name: i for i, name in enumerate(languages)}
    examples: list[Example] = []
    for lang, ids, counted_ids in zip(*(rows.column(k) for k in ("lang", "ids", "counts")), strict=True):
        examples.append((ids.values.to_numpy(), counted_ids.values.to_numpy().astype(np.int64), number[lang.as_py()]))
    if not examples:
        return nothing_learned()
    return train(examples, languages)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row.

    A null text or one without letters is ``und`` with score 0 and rejected.
    A null id is not held out.  Rows of equal id are each judged by their
    own text; other columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            names, score, rejected = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names), pa.array(score), pa.array(rejected)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    held = F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held, "text").mapInArrow(
        predicted, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is not rejected.

    Null texts and those without letters go.  Rows of equal id are each judged
    by their own text; a null id stays; an empty table gives no rows; a model
    without languages rejects everything.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = distinct_names(docs).index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, column=place):
            rejected = shared.value.predict(texts)[2]
            yield batch.filter(pa.array(~rejected, pa.bool_()))

    return filtered(docs, kept)
