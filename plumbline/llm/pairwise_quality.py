"""Quality scores from preference pairs (operator 7).

Bradley-Terry: a document has a worth, and of two documents the worthier is preferred with the logistic probability of
the difference. The worth is a linear function of features of the whole text, so the model is learned by the logistic
loss on feature differences of pairs (a document of label 1, one of label 0). A document passes if its worth lies above
the quantile of worths that equals the share of label 0 among the labelled rows.

Fitted on all labelled rows. Rows of each class are numbered by hash of doc_id; each row of the larger class meets one of
the other, in turn, so that every row is in a pair, and small tables do so in several rounds, for PAIRS pairs or more. The
pairs stay in Spark: a Newton step sums slopes and curvatures over them, and the quantile is found by counting worths in
ever narrower bins. With one class only there are no pairs and all scores are equal. Rows: a null text counts as empty;
repeated rows get the same score; labels that are null or not 0 or 1 are left out; of the texts of one labelled id the one
of least features is learned from. A very long text is a block of its own, scored as a whole.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pieces_of, remainder, running_total, table
from plumbline.session import drop_folder, new_folder, stored

PAIRS, RIDGE, CUT = 30_000, 1e-3, 0.3
TASKS, STEPS, BINS, ROUNDS = 64, 25, 1024, 6  # sums a step sends to the driver; Newton steps; bins and rounds of the quantile

# Kinds of bytes: 0 other, 1 a-z, 2 A-Z, 3 digit, 4 blank, 5 line end, 6 sentence marks, 7 other marks, 8 beyond ASCII
KIND = np.zeros(256, dtype=np.uint8)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 1, 2, 3, 8
KIND[[32, 9, 11, 12]], KIND[[10, 13]] = 4, 5
KIND[[ord(c) for c in ".,;:'"]] = 6
KIND[[ord(c) for c in "!\"#$%&()*+-/<=>?@[\\]^_`{|}~"]] = 7


def features(text: str | None) -> np.ndarray:
    """Measures of a whole text that do not depend on its language."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, w = max(1, len(raw)), max(1, len(words))
    kinds = np.bincount(KIND[np.frombuffer(raw, dtype=np.uint8)], minlength=9) / n
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    most = max(counts.values(), default=0)
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = raw.split(b"\n")
    marks = frozenset(b"!#$%&*?@|~")
    ends = sum(1 for x in words if x[-1] in marks)
    stops = raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")
    upper = sum(1 for x in counts if x.isupper() and len(x) > 1) / max(1, len(counts))
    return np.array([
        *kinds[1:], np.log1p(len(raw)), np.log1p(len(words)), len(raw) / w, len(counts) / w,
        np.log1p(len(counts)) / np.log1p(w), most / w, same / w, ends / w, len(set(lines)) / len(lines),
        len(lines) / w, stops / w, upper, raw.count(b"|") / w, raw.count(b"!!") / w, raw.count(b"http") / w,
        raw.count(b"@") / w, np.log1p(most),
    ])


def design(values: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Scaled features with their squares, so that worth may fall towards both ends."""
    scaled = np.clip((values - middle) / spread, -4, 4)
    return np.concatenate([scaled, scaled ** 2], axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def summed(rows: DataFrame, of) -> np.ndarray:
    """The sum of ``of``, a function from a batch to an array of numbers, over all batches: one row a task is sent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in batches:
            if part.num_rows:
                found = of(part)
                held = found if held is None else held + found
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tolist()], pa.list_(pa.float64()))], ["s"])

    return np.sum([r["s"] for r in rows.coalesce(TASKS).mapInArrow(run, "s array<double>").collect()], axis=0)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and features ``x`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, "text"):
            found = [features(t).tolist() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(pa.float64()))],
                                             ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def paired(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Pairs ``good``, ``bad`` of features in which every row of ``rows`` (doc_id, _label, x) occurs."""
    numbered, _ = running_total(rows.withColumns({"_key": F.xxhash64("doc_id"), "_one": F.lit(1)}),
                                ["_label", "_key", "doc_id"], "_one", "_at")
    many = max(sizes, key=sizes.get)
    few, n = 1 - many, sizes[1 - many]
    at = F.col("_at") - F.when(F.col("_label") == 1, sizes[0]).otherwise(0)
    rounds = min(n, max(1, -(-PAIRS // sizes[many])))
    name = {1: "good", 0: "bad"}
    left = numbered.where(F.col("_label") == many).select(
        F.col("x").alias(name[many]), at.alias("_i"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("_round"))
    left = left.withColumn("_with", F.pmod(F.col("_i") + F.col("_round") * (n // rounds), F.lit(n)))
    right = numbered.where(F.col("_label") == few).select(F.col("x").alias(name[few]), at.alias("_with"))
    return left.join(right, "_with").select("good", "bad")


def fit(rows: DataFrame, pairs: DataFrame, sizes: dict[int, int]) -> dict:
    """Weights by Newton's method on the pairs, and the worth at the quantile of label 0's share."""
    n = sizes[0] + sizes[1]
    def moments(part):
        x = matrix(part.column("x"))
        return np.stack([x.sum(0), (x ** 2).sum(0)])

    sums = summed(rows, lambda part: moments(part).ravel()).reshape(2, -1) / n
    middle = sums[0]
    spread = np.sqrt(np.maximum(sums[1] - middle ** 2, 0)) + 1e-9
    size = 2 * len(middle)
    weights = np.zeros(size)
    for _ in range(STEPS):
        def step(part, weights=weights):
            gap = design(matrix(part.column("good")), middle, spread) - design(matrix(part.column("bad")), middle, spread)
            p = 1 / (1 + np.exp(-np.clip(gap @ weights, -30, 30)))
            return np.r_[len(gap), gap.T @ (1 - p), ((gap * (p * (1 - p))[:, None]).T @ gap).ravel()]

        got = summed(pairs, step)
        slope = got[1:size + 1] / got[0] - RIDGE * weights
        change = np.linalg.solve(got[size + 1:].reshape(size, size) / got[0] + RIDGE * np.eye(size), slope)
        weights = weights + change
        if np.abs(change).max() < 1e-7:
            break
    return {"middle": middle, "spread": spread, "weights": weights,
            "cut": quantile(rows, lambda part: design(matrix(part.column("x")), middle, spread) @ weights, sizes[0])}


def quantile(rows: DataFrame, worth, k: int) -> float:
    """The middle between the ``k`` th least worth and the next one."""
    ends = lambda part: np.array([worth(part).min(), worth(part).max()])
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [ends(part) for part in batches if part.num_rows]
        if found:
            yield pa.RecordBatch.from_pydict({"low": [min(f[0] for f in found)], "high": [max(f[1] for f in found)]})

    low, high = rows.coalesce(TASKS).mapInArrow(least, "low double, high double").agg(F.min("low"), F.max("high")).first()
    for _ in range(ROUNDS):
        edges = np.linspace(low, high, BINS + 1)
        # At or below each edge; the last bin that is kept holds the k th worth, which is above its lower edge or the least.
        below = summed(rows, lambda part: np.searchsorted(np.sort(worth(part)), edges, side="right").astype(float))
        i = int(np.searchsorted(below, k))
        if i == 0 or edges[i] == edges[i - 1]:
            high = edges[i]
            break
        low, high = edges[i - 1], edges[i]
    if summed(rows, lambda part: np.array([(worth(part) <= high).sum()]))[0] > k:
        return float(high)
    def above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [w[w > high].min() for w in (worth(part) for part in batches if part.num_rows) if (w > high).any()]
        if found:
            yield pa.RecordBatch.from_pydict({"next": [min(found)]})

    following = rows.coalesce(TASKS).mapInArrow(above, "next double").agg(F.min("next")).first()[0]
    return float(high) if following is None else float(high + following) / 2


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> dict | None:
    """A model from all labelled documents, or None if a class is missing."""
    spark = docs.sparkSession
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("_label")).distinct()
    folders = [new_folder(spark), new_folder(spark)]
    # Features are joined, not texts, which are many times as large.
    rows = stored(featured(docs).join(known, "doc_id").groupBy("doc_id", "_label").agg(F.min("x").alias("x")), folders[0])
    sizes = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    model = None
    if len(sizes) == 2:
        model = fit(rows, stored(paired(rows, sizes), folders[1]), sizes)
        drop_folder(spark, folders[1])
    drop_folder(spark, folders[0])
    return model


def scored(docs: DataFrame, model: dict | None, cut: float = CUT) -> DataFrame:
    """doc_id and score (0 to 1; ``cut`` at the quantile) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, "text"):
            texts = part.column("text").to_pylist()
            if model is None or not texts:
                scores = np.full(len(texts), cut)
            else:
                x = design(np.stack([features(t) for t in texts]), model["middle"], model["spread"])
                above = np.clip(x @ model["weights"] - model["cut"], -30, 30)
                scores = 1 / (1 + (1 - cut) / cut * np.exp(-above))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())],
                                             ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op7_pairwise_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    return scored(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
