"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from whole texts by the executors. The trees are fitted on
a bounded sample of the labelled rows (`sample_rows`, the lowest hashes of the
doc_id), on quantile bins: each level sums gradients by (node, feature, bin) and
takes the best split of every node. A fitted model is three arrays (feature,
threshold, value) over trees of equal shape, so a batch of documents goes down
all trees at once by indexing.

Defined cases: null and empty texts have the statistics of the empty text and are
scored like any other; labels without a value or a document teach nothing; with
fewer than two classes among them every score is their share of ones (0.5 without
any); a null doc_id is not held out; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import free_name, text_or_empty

STATISTICS = (
    "log_chars log_words word_length word_length_spread upper digit space punctuation symbol "
    "non_ascii byte_entropy log_lines line_length repeated_lines repeated_line_chars "
    "distinct_words rare_words top_word top_pair repeated_pairs same_as_before longest_run "
    "one_letter_words symbol_words long_words stops commas capital_words all_capitals "
    "short_sentences bars exclamations digits_in_words bytes_used").split()
PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", dtype=np.uint8)
SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", dtype=np.uint8)


def statistics(text: str) -> list[float]:
    """The numbers of STATISTICS for one whole text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    count = np.bincount(raw, minlength=256)
    n = max(1, len(raw))
    share = count[count > 0] / n
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    line_count = Counter(lines)
    again = sum(c - 1 for c in line_count.values())
    again_chars = sum((c - 1) * len(x) for x, c in line_count.items())
    word_count = Counter(words)
    pair_count = Counter(zip(words, words[1:]))
    same = run = longest = 0
    before = None
    for x in words:
        if x == before:
            same += 1
            run += 1
            longest = max(longest, run)
        else:
            run = 0
        before = x
    stops = int(count[46] + count[33] + count[63])
    symbol_words = sum(c for x, c in word_count.items() if not (x[0].isalnum() and x[-1].isalnum())
                       and x[-1] not in ".,;:!?\"')")
    return [
        math.log1p(len(text)), math.log1p(len(words)),
        float(lengths.mean()) if len(words) else 0.0, float(lengths.std()) if len(words) else 0.0,
        count[65:91].sum() / n, count[48:58].sum() / n, (count[32] + count[9:14].sum()) / n,
        count[PUNCTUATION].sum() / n, count[SYMBOLS].sum() / n, count[128:].sum() / n,
        float(-(share * np.log2(share)).sum()) if len(raw) else 0.0,
        math.log1p(len(lines)), len(text) / max(1, len(lines)),
        again / max(1, len(lines)), again_chars / max(1, len(text)),
        len(word_count) / w, sum(1 for c in word_count.values() if c == 1) / w,
        max(word_count.values(), default=0) / w, max(pair_count.values(), default=0) / w,
        1 - len(pair_count) / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        same / w, math.log1p(longest),
        float((lengths == 1).sum()) / w, symbol_words / w, float((lengths > 15).sum()) / w,
        stops / w, count[44] / w,
        sum(c for x, c in word_count.items() if x[0].isupper()) / w,
        sum(c for x, c in word_count.items() if len(x) > 1 and x.isupper()) / w,
        w / max(1, stops), count[124] / w, count[33] / w,
        sum(c for x, c in word_count.items() if not x.isalpha() and any(map(str.isdigit, x))) / w,
        float((count > 0).sum()),
    ]


class Trees:
    """Complete trees of one depth: inner node i has children 2 i + 1 and 2 i + 2."""

    def __init__(self, feature, threshold, value, base: float, depth: int):
        self.feature = np.asarray(feature, dtype=np.int64).reshape(-1, 2 ** depth - 1)
        self.threshold = np.asarray(threshold, dtype=np.float64).reshape(-1, 2 ** depth - 1)
        self.value = np.asarray(value, dtype=np.float64).reshape(-1, 2 ** depth)
        self.base, self.depth = base, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None]
        at = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        odds = self.base + self.value[trees, at - (2 ** self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1,
        bins: int = 64, least_rows: int = 8, ridge: float = 1.0) -> Trees:
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return Trees([], [], [], math.log(share / (1 - share)), depth)
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(k)], axis=1)
    flat = binned + np.arange(k) * bins
    base = math.log(y.mean() / (1 - y.mean()))
    odds = np.full(n, base)
    feature, threshold, value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        slope, curve = y - p, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        f_tree, t_tree = [], []
        for level in range(depth):
            nodes = 2 ** level
            key = ((at - (nodes - 1))[:, None] * (k * bins) + flat).ravel()
            shape = (nodes, k, bins)
            size = nodes * k * bins
            g = np.bincount(key, np.repeat(slope, k), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(key, np.repeat(curve, k), size).reshape(shape).cumsum(axis=2)
            c = np.bincount(key, minlength=size).reshape(shape).cumsum(axis=2)
            g_all, h_all, c_all = g[:, :1, -1:], h[:, :1, -1:], c[:, :1, -1:]
            gain = (g ** 2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge)
                    - g_all ** 2 / (h_all + ridge))
            gain[(c < least_rows) | (c_all - c < least_rows)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            f, b = best // bins, best % bins
            # a node without a useful split sends every row left
            useful = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            cut = np.array([cuts[i][j] if u and j < len(cuts[i]) else np.inf
                            for i, j, u in zip(f, b, useful)])
            f_tree += f.tolist()
            t_tree += cut.tolist()
            here = at - (nodes - 1)
            at = 2 * at + 1 + (x[np.arange(n), f[here]] > cut[here])
        leaf = at - (2 ** depth - 1)
        step = rate * np.bincount(leaf, slope, 2 ** depth) / (
            np.bincount(leaf, curve, 2 ** depth) + ridge)
        odds += step[leaf]
        feature.append(f_tree)
        threshold.append(t_tree)
        value.append(step)
    return Trees(feature, threshold, value, base, depth)


def is_held_out(doc_id: str = "doc_id") -> Column:
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000) -> Trees:
    """Trees fitted on at most `sample_rows` labelled rows outside the held-out fold."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .where(~is_held_out()).select("doc_id", F.col("quality").cast("int").alias("y"))
              .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows))

    def numbers(batches):
        for frame in batches:
            out = pd.DataFrame([statistics(t) for t in frame["text"]], columns=STATISTICS)
            out["y"] = frame["y"].to_numpy()
            yield out

    # at most sample_rows ids: a bounded broadcast
    rows = (docs.select("doc_id", text_or_empty("text").alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("text", "y")
            .mapInPandas(numbers, ", ".join(f"{c} double" for c in STATISTICS) + ", y int")
            .toPandas())
    rows = rows.sort_values(list(rows.columns), ignore_index=True)  # not in order of arrival
    return fit(rows[STATISTICS].to_numpy(dtype=np.float64), rows["y"].to_numpy(dtype=np.float64))


def scores_of(texts: list[str], model: Trees) -> np.ndarray:
    out = [model.score(np.array([statistics(t) for t in texts[i:i + 500]]))
           for i in range(0, len(texts), 500)]
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    def scored(batches):
        for frame in batches:
            frame["score"] = scores_of(list(frame.pop("text")), model)
            yield frame

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       is_held_out().alias("held_out"), text_or_empty("text").alias("text"))
    return (rows.mapInPandas(scored, "doc_id string, held_out boolean, score double")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def drop_rejected(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """`docs` with its own columns, without the documents scored below `threshold`."""
    def accepted(batches):
        for batch in batches:
            keep = scores_of(batch.column(0).to_pylist(), model) >= threshold
            yield batch.filter(pa.array(keep)).select(range(1, batch.num_columns))

    name = free_name(docs, "_text")
    return docs.select(text_or_empty("text").alias(name), "*").mapInArrow(accepted, docs.schema)
