"""Toxicity of text that may be disguised (operator 10).

A noisy channel has turned what was meant into what is read: letters into look-alikes (leetspeak), one letter into
several, a word into spaced or dotted letters. The readings of a word form a lattice of characters; the Viterbi
algorithm finds the likeliest path under a character language model (trigrams, counted over all documents) and the
channel's costs. Spaced letters are read as one word and, in the same lattice, as several: the likeliest row of words
known from labelled documents and of unknown ones. Restored words are looked up in a logistic model, whose weights are learned
from labelled documents.

``restore`` decodes every word, as learning does. Scoring decodes the words that can matter: it first walks a word's
lattice along the beginnings of the model's words, and a word none of whose readings is one of them scores alike either
way. A word with look-alikes at its ends is read with and without these. Words without a letter are not decoded.

Fitted on all labelled rows: words are counted, weights fitted and the cut found over all of them, by Spark; the model has
at most FEATURES words, and the words that spaced letters may spell are those of a SHARE of the rows. Rows: a null text
counts as empty; repeated rows get the same score; with no labelled toxic or no labelled clean row all scores are 0; of
the texts of one labelled id the least is learned from. A very long text is a block of its own, scored as a whole.
"""

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pieces_of, remainder, running_total, table
from plumbline.llm.labelled import texts_of
from plumbline.session import drop_folder, new_folder, release, stored

FEATURES, KEPT, STEPS = 1000, 300_000, 100
RIDGE, LEAST, ODD = 0.1, 3, 3.0  # pull of weights to zero; toxic documents that hold a word; deviations from chance
SHARE = 1 / 2000  # of labelled documents that hold a word of the vocabulary (LEAST of 6000)

# Letters that look-alikes may stand for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
         "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i"}
CHANGED, DROPPED, SHORTENED = -3.0, -1.5, -1.0  # log probabilities of what the channel does
NEW = -3.0  # log probability that a word of spaced letters is not in the vocabulary

LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
EDGE, OTHER, ALPHABET = 0, len(LETTERS) + 1, 64
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
TABLE = np.zeros(0x250, dtype=np.int64)
for _c in range(0x250):
    TABLE[_c] = CODE.get(chr(_c), OTHER if chr(_c).isalpha() else EDGE)

SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
RUNS = re.compile(r"(.)\1+")
AROUND = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
MARKS = "".join(c for c in AROUND if c not in LOOKS)  # can only be dropped


def meant(char: str, run: int) -> list[tuple[str, float]]:
    """The texts that ``run`` times a lower-case character may stand for, and what each costs."""
    if char.isalpha():
        options = [(char * run, 0.0)] if run < 3 else [(char * 2, SHORTENED)]
        return options + ([(char, SHORTENED)] if run > 1 else [])
    options = []
    for letter in LOOKS.get(char, ""):
        options += [(letter, CHANGED), *([(letter * 2, CHANGED + SHORTENED)] if run > 1 else [])]
    return [*options, ("", DROPPED)]


def lattice(word: str) -> Iterator[list[tuple[str, float]]]:
    """What each run of one character in a lower-case word may stand for."""
    i = 0
    while i < len(word):
        run = 1
        while i + run < len(word) and word[i + run] == word[i]:
            run += 1
        yield meant(word[i], run)
        i += run


class CharModel:
    """Interpolated character trigrams, as log probabilities."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(ALPHABET, ALPHABET, ALPHABET).astype(np.float64) + 1e-9
        bi, uni = tri.sum(0), tri.sum((0, 1))
        p1 = (uni + 1) / (uni + 1).sum()
        p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
        p3 = (tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).astype(np.float32)

    def decode(self, word: str) -> str:
        """The likeliest reading of a lower-case word."""
        states = {(EDGE, EDGE): (0.0, None)}
        for options in lattice(word):
            states = self.after(states, options)
        return text_of(self.best(states)[1])

    def after(self, states: dict, options: list[tuple[str, float]]) -> dict:
        """The best way to each pair of last letters: its score and what was read, last part first."""
        log, following = self.log, {}
        for (a, b), (score, read) in states.items():
            for more, cost in options:
                x, y, s = a, b, score + cost
                for c in more:
                    k = CODE.get(c, OTHER)
                    s += log[x, y, k]
                    x, y = y, k
                if (x, y) not in following or following[x, y][0] < s:
                    following[x, y] = (s, (read, more))
        return following

    def best(self, states: dict) -> tuple[float, tuple | None]:
        return max(((s + self.log[a, b, EDGE], read) for (a, b), (s, read) in states.items()), key=lambda e: e[0])


def text_of(read: tuple | None) -> str:
    parts = []
    while read:
        read, more = read
        parts.append(more)
    return "".join(reversed(parts))


class Vocabulary:
    """Log probabilities of known words, and whether a text begins one."""

    def __init__(self, chances: dict[str, float]):
        self.chances, self.sorted = chances, sorted(chances)

    def begins(self, text: str) -> bool:
        at = bisect_left(self.sorted, text)
        return at < len(self.sorted) and self.sorted[at].startswith(text)

    def split(self, model: CharModel, letters: str) -> list[str]:
        """The likeliest words that lower-case letters spell. A word takes all of a run of one character, or the first
        one or two of it if it ends there."""
        n = len(letters)
        run = [1] * n
        for i in range(n - 2, -1, -1):
            if letters[i] == letters[i + 1]:
                run[i] = run[i + 1] + 1
        ends: list = [None] * (n + 1)  # best row of words up to here: score, the row before, the last word as read
        ends[0] = (0.0, None, None)
        known: list[dict] = [{} for _ in range(n + 1)]  # within a known word: what was read of it, score, row before
        new: list[dict] = [{} for _ in range(n + 1)]    # within an unknown one, by its last letters

        def end(at: int, score: float, before, word) -> None:
            if ends[at] is None or ends[at][0] < score:
                ends[at] = (score, before, word)

        for i in range(n):
            if ends[i]:
                known[i][""] = max(known[i].get("", (-np.inf, None)), (ends[i][0], ends[i]), key=lambda e: e[0])
                if (EDGE, EDGE) not in new[i] or new[i][EDGE, EDGE][0] < ends[i][0] + NEW:
                    new[i][EDGE, EDGE] = (ends[i][0] + NEW, (None, ends[i]))
            for taken in sorted({1, 2, run[i]}):
                if taken > run[i]:
                    break
                options, to = meant(letters[i], taken), i + taken
                for read, (score, before) in known[i].items():
                    for more, cost in options:
                        text, s = read + more, score + cost
                        if text in self.chances:
                            end(to, s + self.chances[text], before, (None, text))
                        if taken == run[i] and self.begins(text) and (text not in known[to] or known[to][text][0] < s):
                            known[to][text] = (s, before)
                if new[i]:
                    states = model.after(new[i], options)
                    score, read = model.best(states)
                    end(to, score, None, read)
                    if taken == run[i]:
                        new[to] = states
            known[i] = new[i] = None
        out, at = [], ends[n]
        while at and at[2]:
            _, before, read = at
            parts = []
            while isinstance(read, tuple):
                read, more = read
                parts.append(more)
            if before is None:
                before = parts.pop()  # an unknown word's reading begins with the row before it
            out.append("".join(reversed(parts)))
            at = before
        return [w for w in reversed(out) if w]


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all texts, words being set apart by an edge: at most ALPHABET ** 3 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(ALPHABET ** 3, dtype=np.int64)
        for part in pieces_of(batches, "text"):
            joined = "  ".join(["", *(t for t in part.column("text").to_pylist() if t), ""]).lower()
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            for i in range(0, len(points), 1 << 20):
                code = TABLE[np.minimum(points[i:i + (1 << 20) + 2], 0x24F)]
                held += np.bincount((code[:-2] * ALPHABET + code[1:-1]) * ALPHABET + code[2:],
                                    minlength=ALPHABET ** 3)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["at", "n"])

    rows = docs.select("text").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(ALPHABET ** 3)
    counts[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return counts


def plain(word: str) -> str:
    return word.strip(AROUND)


class Restorer:
    """Words of texts as they were meant; with ``only``, no more than those of these words that are among them."""

    def __init__(self, model: CharModel, chances: dict[str, float], only: frozenset[str] | None = None):
        self.model, self.vocabulary, self.only, self.known = model, Vocabulary(chances), only, {}
        self.begun = {w[:i] for w in only or () for i in range(len(w) + 1)}

    def possible(self, word: str, within: bool = False) -> bool:
        """Whether a reading of the word, or a part of one (``within``), is wanted: the lattice, walked along the
        beginnings of wanted words."""
        if self.only is None:
            return True
        read = {""}
        for options in lattice(word):
            read = {r + more for r in read for more, _ in options if r + more in self.begun}
            if within:
                if not self.only.isdisjoint(read):
                    return True
                read.add("")  # another word may begin, in the next run or at its start, which reads the same
            if not read:
                return False
        return not self.only.isdisjoint(read)

    def restored(self, word: str) -> tuple[str, ...]:
        """The likeliest reading without the marks around a word and, if another, with look-alikes among them."""
        bare, found = plain(word), []
        if not any(c.isalpha() for c in word):
            found = [bare]
        else:
            for part in dict.fromkeys([bare, word.strip(MARKS)]):
                if part.isalpha() and not RUNS.search(part):
                    found.append(part)  # the lattice has one path
                elif self.possible(part):
                    found.append(self.model.decode(part))
        return tuple(w for w in dict.fromkeys(found) if self.only is None or w in self.only)

    def words(self, text: str | None) -> list[str]:
        """Restored words of a whole text, then those that spaced letters spell."""
        return self.whole(text) + [w for letters in runs(text) for w in self.spelled(letters)]

    def whole(self, text: str | None) -> list[str]:
        if len(self.known) > KEPT:
            self.known = {}
        known, out = self.known, []
        for word in (text or "").lower().split():
            got = known.get(word)
            if got is None:
                got = known[word] = self.restored(word)
            out += got
        return out

    def spelled(self, letters: str) -> list[str]:
        """What a run of letters spells as one word and as several."""
        found = [self.model.decode(letters)] if self.possible(letters) else []
        if self.possible(letters, True):
            found += self.vocabulary.split(self.model, letters)
        return [w for w in dict.fromkeys(found) if self.only is None or w in self.only]


def runs(text: str | None) -> list[str]:
    """Spaced letters of a text, lower-case and without the blanks."""
    return [r.replace(" ", "").replace("\t", "") for r in SPACED.findall((text or "").lower())]


def restore(docs: DataFrame, counts: np.ndarray, vocabulary: dict[str, float]) -> DataFrame:
    """doc_id and ``restored``: every whole text's words as decoded, joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Restorer(CharModel(counts), vocabulary)
        for part in pieces_of(batches, "text"):
            texts = [" ".join(own.words(t)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "restored"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, restored string")


def logistic(rows: DataFrame, words: list[str]) -> np.ndarray:
    """Weights of a logistic model on the sets ``words`` of labelled rows, fitted by Spark over all of them; ``RIDGE``
    counts against the sum over rows."""
    sets = CountVectorizerModel.from_vocabulary(words, "words", "x").setBinary(True).transform(rows).select(
        F.col("label").cast("double").alias("label"), "x")
    model = LogisticRegression(featuresCol="x", labelCol="label", family="binomial", standardization=False,
                               regParam=RIDGE / max(1, rows.count()), maxIter=STEPS)
    return model.fit(sets).coefficients.toArray()


def best_cut(rows: DataFrame, weights: dict[str, float]) -> float:
    """The sum of weights at which fewest labelled rows fall on the wrong side: between two sums that occur, and above
    that of a row without any word. Rows are counted by sum, and counts added up in order of sums, by Spark."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sums = [round(sum(weights.get(w, 0.0) for w in words), 9) for words in part.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(sums, pa.float64())], ["label", "sum"])

    found = rows.select("label", "words").mapInArrow(weigh, "label int, sum double").groupBy("sum").agg(
        F.sum(2 * F.col("label") - 1).alias("more"))
    none = rows.sparkSession.createDataFrame([(0.0, 0)], "sum double, more bigint")
    found = found.unionByName(none).groupBy("sum").agg(F.sum("more").alias("more"))
    # With the cut right above a sum, toxic rows up to it are wrong and clean ones are not.
    ordered, _ = running_total(found, ["sum"], "more", "_before")
    at = ordered.orderBy(F.col("_before") + F.col("more"), "sum").first()["sum"]
    following = ordered.where(F.col("sum") > at).agg(F.min("sum")).first()[0]
    return at + 1 if following is None else (at + following) / 2


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict | None:
    """Character counts over all documents, and word weights from all labelled ones."""
    spark = docs.sparkSession
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("_label")).distinct()
    counts = char_counts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Restorer(CharModel(counts), {})
        for part in pieces_of(batches, "text"):
            texts = part.column("text").to_pylist()
            found = [sorted({w for w in own.whole(t) if w}) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("_label"), pa.array(found, pa.list_(pa.string())),
                 pa.array([runs(t) for t in texts], pa.list_(pa.string()))], ["label", "whole", "runs"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Restorer(CharModel(counts), vocabulary)
        for part in batches:
            found = [sorted({w for w in [*whole, *(w for r in spaced for w in own.spelled(r))] if len(w) > 2})
                     for whole, spaced in zip(part.column("whole").to_pylist(), part.column("runs").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array(found, pa.list_(pa.string()))], ["label", "words"])

    folders = [new_folder(spark) for _ in range(3)]
    rows = texts_of(docs, known)
    first = stored(rows.mapInArrow(run, "label int, whole array<string>, runs array<string>"), folders[0])
    del rows
    release(spark)  # the shuffle of texts, before words are shuffled
    sizes = {r["label"]: r["n"] for r in first.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        drop_folder(spark, folders[0])
        return None
    # The words that spaced letters may spell: a share of the rows, so that there are boundedly many at every size.
    total = sizes[0] + sizes[1]
    often = first.select(F.explode("whole").alias("word")).groupBy("word").count().where(
        F.col("count") >= max(LEAST, total * SHARE)).orderBy("word").toPandas()
    vocabulary = dict(zip(often["word"], np.log(often["count"] / max(1, often["count"].sum())).tolist()))
    read = stored(first.mapInArrow(spell, "label int, words array<string>"), folders[1])
    seen = read.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    # How much oftener than chance a word is in toxic documents, in standard deviations: the FEATURES largest.
    chance = (F.col("toxic") + F.col("clean")) * (sizes[1] / total)
    odd = (F.col("toxic") - chance) / F.sqrt(chance + 1)
    best = [r["word"] for r in seen.where(F.col("toxic") >= LEAST).withColumn("odd", odd).where(
        F.col("odd") > ODD).orderBy(F.desc("odd"), "word").limit(FEATURES).collect()]
    # Of each row only the chosen words are kept, which are few.
    chosen = stored(read.select("label", F.array_intersect("words", F.lit(best).cast("array<string>")).alias("words")), folders[2])
    weights = np.maximum(logistic(chosen, best), 0).tolist() if best else []
    words = {word: w for word, w in zip(best, weights) if w > 0}
    bias = -best_cut(chosen, words)
    for folder in folders:
        drop_folder(spark, folder)
    return {"counts": counts, "vocabulary": vocabulary, "words": words, "bias": float(bias)}


def scorer(model: dict):
    """A function from a text to its score."""
    words = model["words"]
    own = Restorer(CharModel(model["counts"]), model.get("vocabulary", {}), frozenset(words))

    def score(text: str | None) -> float:
        z = model["bias"] + sum(words[w] for w in set(own.words(text)) & words.keys())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model) if model else lambda text: 0.0
        for part in pieces_of(batches, "text"):
            scores = [score(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())],
                                             ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op10_noisy_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    return scored(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
