"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams for every n of a range (presence, not counts),
hashed into a fixed number of bins per n.  k(x, y) = |x & y| / sqrt(|x| |y|).  Nystroem:
landmark texts give the feature map K_mm^-1/2 k(landmarks, x); one-versus-rest ridge
regression is solved in that space.  Scoring is a product of a batch's presence matrix
with (landmarks x Nystroem map x weights), which is folded into one matrix at the fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import MUL, U, slices, stage, text_buffers


@dataclass
class Kernel:
    """n-gram lengths and bins (a power of two) for each length."""

    lengths: tuple[int, ...] = (1, 2, 3, 4)
    bins: int = 1 << 12

    @property
    def width(self) -> int:
        return self.bins * len(self.lengths)


@dataclass
class Model:
    kernel: Kernel
    langs: list[str]
    weights: np.ndarray  # width x languages, float32
    bias: np.ndarray


def presence(kernel: Kernel, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Presence matrix (rows x width, uint8) of the rows' byte n-grams; n-grams stay inside rows."""
    rows = len(offs) - 1
    out = np.zeros((rows, kernel.width), np.uint8)
    shift = U(64 - (kernel.bins.bit_length() - 1))
    flat = out.reshape(-1)
    row = np.repeat(np.arange(rows, dtype=np.int64) * kernel.width, np.diff(offs))
    left = np.repeat(offs[1:], np.diff(offs)) - np.arange(len(raw))  # bytes from here to the row's end
    code = np.zeros(len(raw), U)
    for k, n in enumerate(kernel.lengths):
        m = len(raw) - n + 1
        if m <= 0:
            break
        code = np.zeros(m, np.uint32)
        for i in range(n):
            code = (code << np.uint32(8)) | raw[i:m + i]
        slot = ((code.astype(U) * MUL) >> shift).astype(np.int64)
        at = slot + row[:m] + k * kernel.bins
        flat[at[left[:m] >= n]] = 1
    return out


def normal(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, label: str, kernel: Kernel | None = None, per_label: int = 400,
        landmarks: int = 256, ridge: float = 1e-2, seed: int = 7, parts: int = 16) -> Model:
    """Fit on about ``per_label`` distinct texts of each label (a hash of the text and label picks them).

    Distinct texts are counted over all rows, so a label made of copies of few texts teaches all of them; no label is
    left out.  The sample is the documented bound.  The landmarks (``landmarks`` packed presence rows of the sample) come to
    the driver; the Gram sums are made in tasks, and at most ``parts`` of them, each of the landmarks' size, are added
    up there.  Rows with a null label or null text teach nothing.
    """
    kernel = kernel or Kernel()
    rows = docs.select(F.col(label).alias("lang"), normal(F.col("text")).alias("text")).where(
        F.col("lang").isNotNull() & has_letter(F.col("text")))
    keyed = rows.withColumn("h", F.xxhash64("text", "lang", F.lit(seed)))
    counts = keyed.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    chosen = (keyed.join(counts, "lang")
              .where(F.pmod("h", F.lit(1 << 30)) < F.least(F.lit(1.0), F.lit(float(per_label)) / F.col("n")) * float(1 << 30))
              .select("lang", "text", "h").dropDuplicates(["lang", "text"]))  # copies of one text teach once

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            raw, offs = text_buffers(batch.column("text"))
            bits = []
            for lo in range(0, batch.num_rows, 512):
                o = offs[lo:lo + 513]
                bits += [x.tobytes() for x in np.packbits(presence(kernel, raw[o[0]:o[-1]], o - o[0]), axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(bits, pa.binary())],
                                             names=["lang", "h", "bits"])

    def rows_of(bits: list[bytes]) -> np.ndarray:
        x = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1)[:, :kernel.width]
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True, dtype=np.float64), 1))

    sample = stage(chosen.mapInArrow(features, "lang string, h long, bits binary"), "langid-sample")
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not langs:
        return Model(kernel, [], np.zeros((kernel.width, 0), np.float32), np.zeros(0))
    z = rows_of([r["bits"] for r in sample.orderBy(F.xxhash64("h", F.lit(seed)), "lang").limit(landmarks).select("bits").collect()])
    values, vectors = np.linalg.eigh(z @ z.T)
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # K_mm^-1/2 on its range
    sent, d, place = docs.sparkSession.sparkContext.broadcast(z.T @ root), root.shape[1], {w: i for i, w in enumerate(langs)}

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of phi phi', phi y', phi, y and 1 over the rows of the task, as one packed matrix."""
        total = np.zeros((d + 1, d + 1 + len(langs)))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                phi = rows_of(part.column("bits").to_pylist()) @ sent.value
                phi = np.concatenate((phi, np.ones((len(phi), 1))), axis=1)
                y = np.full((len(phi), len(langs)), -1.0)
                y[np.arange(len(phi)), [place[w] for w in part.column("lang").to_pylist()]] = 1.0
                total += phi.T @ np.concatenate((phi, y), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    total = sum(np.frombuffer(r["sums"], np.float64).reshape(d + 1, -1)
                for r in sample.coalesce(parts).mapInArrow(gram, "sums binary").collect())
    n = total[d, d]
    mean_phi, mean_y = total[d, :d] / n, total[d, d + 1:] / n
    spread = total[:d, :d] - n * np.outer(mean_phi, mean_phi)
    beta = np.linalg.solve(spread + ridge * n * np.eye(d), total[:d, d + 1:] - n * np.outer(mean_phi, mean_y))
    return Model(kernel, langs, (z.T @ root @ beta).astype(np.float32), mean_y - mean_phi @ beta)


def predict(docs: DataFrame, model: Model, undetermined: str = "und", sharpness: float = 4.0) -> DataFrame:
    """``docs`` plus lang_pred and score (softmax of the one-versus-rest outputs, 0 to 1).

    Every whole text is read.  A text that is null or has no letter is ``undetermined``
    with score 0, as is every text when nothing was learned; ties go to the first label in
    order.  Repeated rows get equal results; other columns pass through, and columns named
    lang_pred or score are replaced; no rows give no rows.
    """
    base = docs.drop("lang_pred", "score")
    names = base.columns
    told, lettered = "_text" + "_" * len(max(names, key=len)), "_letter" + "_" * len(max(names, key=len))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        for batch in slices(batches, told, 1 << 20):
            letter = batch.column(lettered).to_numpy(zero_copy_only=False).astype(bool)
            raw, offs = text_buffers(batch.column(told))
            n = batch.num_rows
            best, score = np.zeros(n, np.int64), np.zeros(n)
            for lo in range(0, n, 512) if m.langs else ():
                hi = min(n, lo + 512)
                p = presence(m.kernel, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]).astype(np.float32)
                size = np.sqrt(np.maximum(p.sum(axis=1, keepdims=True, dtype=np.float64), 1))
                out = (p @ m.weights).astype(np.float64) / size + m.bias
                e = np.exp(sharpness * (out - out.max(axis=1, keepdims=True)))
                best[lo:hi] = out.argmax(axis=1)
                score[lo:hi] = e[np.arange(hi - lo), best[lo:hi]] / e.sum(axis=1)
            known = letter & bool(m.langs)
            pred = pa.array([m.langs[b] if k else undetermined for b, k in zip(best.tolist(), known.tolist())],
                            pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))] + [pred, pa.array(np.where(known, score, 0.0))],
                names=[*names, "lang_pred", "score"])

    fed = base.select(*names, normal(F.col("text")).alias(told), has_letter(F.col("text")).alias(lettered))
    out = base.schema.add("lang_pred", "string").add("score", "double")
    return fed.mapInArrow(run, out)

