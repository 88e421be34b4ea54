"""Language identification by a byte convolutional network, trained and applied in numpy.

Text is cut into windows of a fixed number of bytes. Bytes are embedded; filters of
several widths run over them; each filter's largest response in the window goes to a
softmax over languages. A document's prediction is the mean of its windows'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.worker import release

UNKNOWN = "und"
WINDOW = 192
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 8, 8


def cut_windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts as rows of `size` bytes (the last of a text padded with zeros),
    and the number of the text of each row."""
    counts = np.array([-(-len(t) // size) for t in texts], dtype=np.int64)
    flat = b"".join(t.ljust(n * size, b"\0") for t, n in zip(texts, counts))
    return np.frombuffer(flat, np.uint8).reshape(-1, size), np.repeat(np.arange(len(texts)), counts)


class ByteConvNet:
    """Parameters of the network; `labels` are the languages in order of the outputs."""

    def __init__(self, labels: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.embed = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)).astype(np.float32)
                        for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.zeros((FILTERS * len(WIDTHS), len(labels)), np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def _parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]

    def _pooled(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response per filter, and where it was."""
        best, where = [], []
        for w, kernel, bias in zip(WIDTHS, self.filters, self.bias):
            span = rows.shape[1] - w + 1
            reply = sum((self.embed @ kernel[j])[rows[:, j:j + span]] for j in range(w))
            at = reply.argmax(axis=1)
            where.append(at)
            best.append(np.take_along_axis(reply, at[:, None], axis=1)[:, 0] + bias)
        return np.concatenate(best, axis=1), where

    @staticmethod
    def _softmax(scores: np.ndarray) -> np.ndarray:
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def fit(self, rows: np.ndarray, labels: np.ndarray, epochs: int = 6, least_steps: int = 520, batch: int = 128, rate: float = 0.004,
            seed: int = 0) -> "ByteConvNet":
        """Adam on the cross-entropy, `epochs` times over all rows; few rows are gone over again
        until `least_steps` batches are done. `labels` are indexes into `self.labels`."""
        rng = np.random.default_rng(seed)
        parameters = self._parameters()
        first, second, step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
        epoch = 0
        while len(rows) and (epoch < epochs or step < least_steps):
            epoch += 1
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                grads = self._gradient(rows[own], labels[own])
                step += 1
                for p, g, m, v in zip(parameters, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, rows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        raw, where = self._pooled(rows)
        hidden = np.maximum(raw, 0)
        error = self._softmax(hidden @ self.out + self.out_bias)
        error[np.arange(len(rows)), labels] -= 1
        error /= len(rows)
        back = (error @ self.out.T) * (raw > 0)
        embed, kernels, biases = np.zeros_like(self.embed), [], []
        for i, (w, kernel) in enumerate(zip(WIDTHS, self.filters)):
            own, at = back[:, i * FILTERS:(i + 1) * FILTERS], where[i]
            grad = np.zeros_like(kernel)
            for j in range(w):
                seen = np.take_along_axis(rows, at + j, axis=1)  # the byte under filter f, place j
                for f in range(FILTERS):
                    grad[j, :, f] = own[:, f] @ self.embed[seen[:, f]]
                    np.add.at(embed, seen[:, f], own[:, f, None] * kernel[j, :, f])
            kernels.append(grad)
            biases.append(own.sum(axis=0))
        return [embed, *kernels, *biases, hidden.T @ error, error.sum(axis=0)]

    def tables(self) -> list[list[np.ndarray]]:
        """Filter responses by pairs of bytes: a filter of width w reads ceil(w / 2) rows of them."""
        found = []
        for w, kernel in zip(WIDTHS, self.filters):
            single = [self.embed @ kernel[j] for j in range(w)]
            found.append([(single[j][:, None, :] + single[j + 1][None, :, :]).reshape(65536, FILTERS)
                          if j + 1 < w else single[j] for j in range(0, w, 2)])
        return found

    def predict(self, rows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Probabilities per window."""
        out = np.empty((len(rows), len(self.labels)), np.float32)
        for at in range(0, len(rows), 256):
            part = rows[at:at + 256]
            pairs = part[:, :-1].astype(np.uint16) << 8 | part[:, 1:]
            best = []
            for w, own, bias in zip(WIDTHS, tables, self.bias):
                span = part.shape[1] - w + 1
                reply = np.take(own[0], pairs[:, :span], axis=0)
                for j in range(1, len(own)):
                    reply += np.take(own[j], pairs[:, 2 * j:2 * j + span] if 2 * j + 1 < w
                                     else part[:, 2 * j:2 * j + span], axis=0)
                best.append(reply.max(axis=1) + bias)
            hidden = np.maximum(np.concatenate(best, axis=1), 0)
            out[at:at + 256] = self._softmax(hidden @ self.out + self.out_bias)
        return out


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 600,
          chars: int = 800, seed: int = 0) -> ByteConvNet | None:
    """A network fitted on a bounded sample: about `rows_per_language` rows of each language,
    chosen by a hash of the text, and `chars` characters of each from a hashed place on.

    Rows without text or language are left out. None without any row."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1_000_000))
    limit = F.coalesce(*(F.when(F.col("lang") == F.lit(k), F.lit(int(1_000_000 * rows_per_language / n) + 1))
                         for k, n in sizes.items()))
    begin = F.pmod(F.xxhash64("text", F.lit(seed + 1)), F.greatest(F.length("text") - chars + 1, F.lit(1)))
    chosen = (rows.filter(draw < limit).select("lang", F.substring("text", (begin + 1).cast("int"), chars).alias("part"))
              .groupBy("lang", "part").agg(F.count("*")).limit(2 * rows_per_language * len(sizes)))
    found = sorted((r["lang"], r["part"]) for r in chosen.select("lang", "part").collect())
    labels = sorted(sizes)
    windows, owner = cut_windows([t.encode() for _, t in found])
    own = np.array([labels.index(k) for k, _ in found], dtype=np.int64)[owner]
    return ByteConvNet(labels, seed).fit(windows, own, seed=seed)


def identify(docs: DataFrame, model: ByteConvNet | None, text_col: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score` in place of columns so named.

    Every window of the whole text counts, by its length. `und` with score 0 if the text
    is null or has no letter, or if there was nothing to learn from; else a learned
    language and its mean probability. Only the text is read. Rows are kept as they are.
    """
    out = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in out]
    kept = docs.select(*(F.col(f"`{n}`") for n in names))
    place = names.index(text_col)
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in out),
                        "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        tables = model.tables() if model else None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(place).to_pylist()
                live = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
                lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if live:
                    raw = [texts[i].encode("utf-8", "surrogatepass") for i in live]
                    windows, owner = cut_windows(raw)
                    filled = (windows != 0).sum(axis=1) + 1e-6
                    weight = np.zeros((len(raw), len(model.labels)))
                    np.add.at(weight, owner, model.predict(windows, tables) * filled[:, None])
                    weight /= weight.sum(axis=1, keepdims=True)
                    for i, w in zip(live, weight):
                        lang[i], score[i] = model.labels[int(w.argmax())], float(min(1.0, w.max()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*names, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)
