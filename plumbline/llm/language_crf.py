"""Language of the words of code-switched text, by a linear-chain conditional random field (operator 3).

A word's features are its affixes, its character n-grams and whether it is in the lexicon of a language; each has one
weight per language, and neighbouring words are bound by learned transitions. Forward-backward gives each word's
probability of each language; a document's is the mean over its words.

Fitted on at most SAMPLE documents per language. Training sequences are spliced from stretches of documents of
different languages, so that transitions are learned from switches as well as from stretches.

Words are what white space sets apart, without the marks around them; those without a letter take no part. Rows: a text
that is null or has no letter is ``und`` with score 0, and so is every text if nothing could be learned; repeated rows
get the same result; training rows with a null language or text are left out, and of an id's texts in a language the
least is learned from. A very long text is a block of its own, tagged as a whole. Columns beside doc_id, text and lang
are not read; an empty table gives an empty one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pieces_of, remainder, table
from plumbline.llm.labelled import drawn, one_text_each

SAMPLE, LEXICON, WIDTH = 250, 2000, 1 << 15
SEQUENCES, STRETCHES, STEPS, RIDGE, SEED = 1500, 4, 40, 1e-3, 3
KEPT = 400_000
MIX = np.uint64(0x9E3779B97F4A7C15)
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”„’…–—¿¡"


def bare(token: str) -> str:
    """A token as the model sees it; empty without a letter."""
    word = token.strip(MARKS).lower()
    return word if any(c.isalpha() for c in word) else ""


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(word position, feature) pairs: hashed prefixes and suffixes of 1 to 3 characters, bigrams and trigrams of the
    word between its edges, and one feature per set of lexicons that hold it."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    start = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - start[row]
    gram = {1: codes}
    for n in (2, 3, 4):
        gram[n] = gram[n - 1][:-1] * np.uint64(1_000_003) + codes[n - 1:] if len(codes) >= n else codes[:0]
    rows, keys = [], []

    def add(where, n, kind):
        rows.append(row[where])
        keys.append(gram[n][where] * np.uint64(31) + np.uint64(kind))

    for n in (2, 3):
        add(np.flatnonzero(place[:len(gram[n])] + n <= sizes[row[:len(gram[n])]]), n, n)
    for n in (2, 3, 4):  # with the edge: affixes of 1 to 3 characters
        fits = np.flatnonzero(sizes >= n + 1)
        add(start[fits], n, 10 + n)
        add(start[fits] + sizes[fits] - n, n, 20 + n)
    feature = ((np.concatenate(keys) * MIX) >> np.uint64(64 - 15)).astype(np.int64)
    known = [(i, WIDTH + lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    at, extra = zip(*known) if known else ((), ())
    return (np.concatenate([*rows, np.array(at, dtype=np.int64)]), np.concatenate([feature, np.array(extra, np.int64)]))


def emissions(words: list[str], model: dict) -> np.ndarray:
    row, feature = word_features(words, model["lexicon"])
    weights = model["weights"]
    return np.stack([np.bincount(row, weights=weights[:, k][feature], minlength=len(words))
                     for k in range(weights.shape[1])], axis=1)


class Packed:
    """Sequences of numbers, longest first, stored step by step: those that reach step t are the first width[t]."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        top = int(self.lengths[0]) if len(lengths) else 0
        self.width = len(lengths) - np.searchsorted(self.lengths[::-1], np.arange(top), side="right")
        self.at = np.r_[0, np.cumsum(self.width)]

    def index(self) -> np.ndarray:
        """For each stored place, the place in the sequences laid end to end in their given order."""
        start = np.empty(len(self.order), dtype=np.int64)
        given = np.empty(len(self.order), dtype=np.int64)
        given[self.order] = self.lengths
        start = np.r_[0, np.cumsum(given)[:-1]][self.order] if len(given) else start
        step = np.repeat(np.arange(len(self.width)), self.width)
        return start[np.arange(self.at[-1]) - self.at[step]] + step


def forward_backward(packed: Packed, shine: np.ndarray, first: np.ndarray, across: np.ndarray, pairs: bool = False):
    """Probabilities of each label at each stored place, and with ``pairs`` the expected numbers of label pairs.
    ``shine``: emission factors by place; ``first``, ``across``: start and transition factors."""
    at, width = packed.at, packed.width
    front = np.empty_like(shine)
    for t in range(len(width)):
        here = slice(at[t], at[t + 1])
        a = shine[here] * (first if t == 0 else front[at[t - 1]:at[t - 1] + width[t]] @ across)
        front[here] = a / a.sum(1, keepdims=True)
    back = np.ones((len(packed.order), shine.shape[1]))
    expected = np.zeros_like(across)
    for t in range(len(width) - 1, -1, -1):
        here = slice(at[t], at[t + 1])
        if t + 1 < len(width):
            n = width[t + 1]
            ahead = shine[at[t + 1]:at[t + 2]] * back[:n]
            if pairs:
                a = front[at[t]:at[t] + n]
                scale = ((a @ across) * ahead).sum(1)
                expected += across * ((a / scale[:, None]).T @ ahead)
            b = ahead @ across.T
            back[:n] = b / b.sum(1, keepdims=True)
        front[here] *= back[:width[t]]
        front[here] /= front[here].sum(1, keepdims=True)
    return (front, expected) if pairs else front


def train(texts: list[list[str]], labels: list[int], langs: list[str]) -> dict:
    """Fit to documents (lists of bare words) and their languages."""
    rng = np.random.default_rng(SEED)
    count = len(langs)
    seen: list[dict[str, int]] = [{} for _ in langs]
    for words, label in zip(texts, labels):
        for w in words:
            seen[label][w] = seen[label].get(w, 0) + 1
    held: dict[str, int] = {}
    for k, counts in enumerate(seen):
        for w in sorted((w for w, n in counts.items() if n > 2), key=lambda w: (-counts[w], w))[:LEXICON]:
            held[w] = held.get(w, 0) | 1 << k
    sets = {s: i for i, s in enumerate(sorted(set(held.values())))}
    lexicon = {w: sets[s] for w, s in held.items()}
    by_label = [[t for t, y in zip(texts, labels) if y == k and t] for k in range(count)]
    usable = [k for k in range(count) if by_label[k]]
    chains, tags = [], []
    for _ in range(SEQUENCES):
        chain, tag = [], []
        for _ in range(STRETCHES):
            k = usable[rng.integers(len(usable))]
            words = by_label[k][rng.integers(len(by_label[k]))]
            n = int(rng.integers(8, 40))
            begin = int(rng.integers(0, max(1, len(words) - n + 1)))
            part = words[begin:begin + n]
            chain += part
            tag += [k] * len(part)
        chains.append(chain)
        tags.append(tag)
    vocabulary = {w: i for i, w in enumerate(sorted({w for c in chains for w in c}))}
    row, feature = word_features(list(vocabulary), lexicon)
    packed = Packed(np.array([len(c) for c in chains]))
    place = packed.index()
    word = np.array([vocabulary[w] for c in chains for w in c])[place]
    target = np.array([y for t in tags for y in t])[place]
    step = np.repeat(np.arange(len(packed.width)), packed.width)
    observed = np.zeros((count, count))
    for t in range(1, len(packed.width)):
        n = packed.width[t]
        np.add.at(observed, (target[packed.at[t - 1]:packed.at[t - 1] + n], target[packed.at[t]:packed.at[t + 1]]), 1)
    weights = np.zeros((WIDTH + len(sets), count))
    transition, start = np.zeros((count, count)), np.zeros(count)
    memory = [np.full_like(x, 1e-8) for x in (weights, transition, start)]
    for _ in range(STEPS):
        score = np.stack([np.bincount(row, weights=weights[:, k][feature], minlength=len(vocabulary))
                          for k in range(count)], axis=1)[word]
        shine = np.exp(np.clip(score - score.max(1, keepdims=True), -40, 0))
        chance, expected = forward_backward(packed, shine, np.exp(start), np.exp(transition), pairs=True)
        gap = chance.copy()
        gap[np.arange(len(target)), target] -= 1
        by_word = np.stack([np.bincount(word, weights=gap[:, k], minlength=len(vocabulary)) for k in range(count)], 1)
        slopes = [
            np.stack([np.bincount(feature, weights=by_word[:, k][row], minlength=len(weights)) for k in range(count)], 1)
            + RIDGE * weights, expected - observed, gap[step == 0].sum(0)]
        for value, slope, rate, m in zip((weights, transition, start), slopes, (0.3, 0.3, 0.1), memory):
            m += slope ** 2
            value -= rate * slope / np.sqrt(m)
    return {"langs": langs, "lexicon": lexicon, "weights": weights, "transition": transition, "start": start}


def learn(docs: DataFrame, bound: int = SAMPLE) -> dict | None:
    """A model from the documents' text and lang: at most ``bound`` documents of each language, by least hash of id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # At most ``bound`` ids of each language, one text an id.
    chosen = drawn(known.select("doc_id", "lang").distinct(), "lang", bound)
    rows = one_text_each(known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]),
                         "doc_id", "lang")
    got = sorted((r["lang"], r["text"]) for r in rows.select("lang", "text").distinct().collect())
    langs = sorted({lang for lang, _ in got})
    texts = [[w for w in map(bare, text.split()) if w] for _, text in got]
    if not any(texts):
        return None
    return train(texts, [langs.index(lang) for lang, _ in got], langs)


class Tagger:
    """Languages of whole texts, with the emissions of words kept."""

    def __init__(self, model: dict):
        self.model = model
        self.first, self.across = np.exp(model["start"]), np.exp(model["transition"])
        self.forget()

    def forget(self):
        self.known = {}
        self.shine = np.ones((0, len(self.model["langs"])))

    def chances(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text, the probabilities (words x languages) of its words with letters."""
        if len(self.known) > KEPT:
            self.forget()
        tokens = [(t or "").split() for t in texts]
        new = list({w for ws in tokens for w in ws if w not in self.known})
        words = [bare(w) for w in new]
        some = [w for w in dict.fromkeys(words) if w]
        if some:
            score = emissions(some, self.model)
            factor = np.exp(np.clip(score - score.max(1, keepdims=True), -40, 0))
            at = {w: i for i, w in enumerate(some, len(self.shine))}
            self.shine = np.concatenate([self.shine, factor])
        self.known.update((w, at[b] if b else -1) for w, b in zip(new, words))
        known = self.known
        rows = [np.array([known[w] for w in ws], dtype=np.int64) for ws in tokens]
        rows = [r[r >= 0] for r in rows]
        lengths = np.array([len(r) for r in rows])
        packed = Packed(lengths)
        place = packed.index()
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        found = forward_backward(packed, self.shine[flat[place]], self.first, self.across)
        back = np.empty_like(found)
        back[place] = found
        return np.split(back, np.cumsum(lengths)[:-1]) if len(rows) else []


def words_labelled(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, ``words`` (those with a letter) and ``langs``, the likeliest language of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tagger(model)
        names = np.array(model["langs"], dtype=object)
        for part in pieces_of(batches, "text"):
            texts = part.column("text").to_pylist()
            words = [[w for w in (t or "").split() if bare(w)] for t in texts]
            langs = [names[c.argmax(1)].tolist() if len(c) else [] for c in own.chances(texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words, pa.list_(pa.string())), pa.array(langs, pa.list_(pa.string()))],
                ["doc_id", "words", "langs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, words array<string>, langs array<string>")


def identified(docs: DataFrame, model: dict | None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The key columns, lang_pred and score (mean probability over the words) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tagger(model) if model else None
        for part in pieces_of(batches, "text"):
            texts = part.column("text").to_pylist()
            langs, scores = [], []
            for chances in own.chances(texts) if own else [()] * len(texts):
                mean = np.mean(chances, axis=0) if len(chances) else None
                langs.append("und" if mean is None else model["langs"][int(mean.argmax())])
                scores.append(0.0 if mean is None else min(1.0, float(mean.max())))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in keys), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*keys, "lang_pred", "score"])

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, "text").mapInArrow(run, f"{kinds}, lang_pred string, score double")


def op3_language_crf(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 4) == 2
    return identified(docs, learn(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")
