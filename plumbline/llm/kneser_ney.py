"""Scoring with an interpolated modified Kneser-Ney model of word pairs (operator 9).

Counting is Spark's: tasks sum what they read into sorted arrays, which are dealt to shards and merged there. The model
is stored as sorted arrays in the shared folder, and workers map them into memory to score:

* the vocabulary: 64-bit hashes of words in order, cut into shards by their first bits; a word's id is its place;
* per cell (a range of first words) the pairs of ids as 64-bit keys in order, and their counts. The range of a very
  frequent word, a third of all tokens say, has several cells by its second words, so no task holds all its pairs;
* per word: its count, its count as a context and how many second words it has once, twice, and oftener, and the number
  of different words before it.

p(w | v) = (c(vw) - D(c(vw))) / c(v) + g(v) p(w), where p(w) is the same on numbers of different words before, down to
1 / (V + 1) for every word, the unknown one included. Nothing is pruned, so the model grows with the corpus. A worker
touches the pages of the entries that its texts need. Words are never Python objects: a block of text is hashed, sorted
and looked up as arrays. More than 2^32 different words are refused.

Rows: a null text is empty and has only its end token; repeated rows count and score each; without any training row all
scores are 0. Words are told apart by 64-bit hashes. A very long text is a block of its own. Other columns are not read.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pieces_of, remainder, table
from plumbline.llm.model_files import mapped, save
from plumbline.llm.word_hashes import dense, hashed
from plumbline.session import cut_lineage, drop_folder, new_folder, stored

END = xxhash.xxh64_intdigest(b" ")  # stands for the end of a text, and for the context of its first word
SHARD_CHARS = 24 << 20              # characters of text per shard of the model
HELD, BLOCK, OPEN = 2_000_000, 6 << 20, 8_000
LOW = np.uint64(0xFFFFFFFF)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words end to end, each text followed by the end token, and their numbers."""
    words, sizes = hashed(texts, lower=True)
    sizes = sizes + 1
    found = np.full(sizes.sum(), END, dtype=np.uint64)
    inner = np.ones(len(found), dtype=bool)
    inner[np.cumsum(sizes) - 1] = False
    found[inner] = words
    return found, sizes


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


class Held:
    """Keys and counts of a task, summed and handed out before they become many."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> bool:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        return self.size > HELD

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        got = summed(np.concatenate(self.keys), np.concatenate(self.counts)) if self.keys else (
            np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.__init__()
        return got


def by_shard(keys: np.ndarray, counts: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut sorted keys at the first keys of shards."""
    yield from runs(np.searchsorted(edges, keys, side="right") - 1, keys, counts)


def runs(shards: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Rows with their shards in order, as one part per shard."""
    cut = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else []
    for start, end in zip(cut, [*cut[1:], len(shards)]):
        yield int(shards[start]), *(c[start:end] for c in columns)


class Cells:
    """Where the counts of pairs lie: one cell for each shard of first words, or, where a shard has many tokens because
    a word is very frequent, several of them by the shard of the second word."""

    def __init__(self, starts: tuple[int, ...], totals: list[int]):
        self.starts = np.array(starts, dtype=np.int64)
        fair = 2 * max(1, sum(totals) // len(totals))
        self.parts = np.clip(-(-np.array(totals, dtype=np.int64) // fair), 1, len(totals))
        self.first = np.cumsum(self.parts) - self.parts

    def of(self, keys: np.ndarray) -> np.ndarray:
        head, tail = (np.searchsorted(self.starts, ids.astype(np.int64), side="right") - 1
                      for ids in (keys >> np.uint64(32), keys & LOW))
        return self.first[head] + tail * self.parts[head] // len(self.starts)

    def dealt(self, keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Cells with their part of sorted keys, in order."""
        cell = self.of(keys)
        order = np.argsort(cell, kind="stable")
        yield from runs(cell[order], keys[order], values[order])

    def shard(self, cell: int) -> int:
        return int(np.searchsorted(self.first, cell, side="right")) - 1


def rows_of(found) -> pa.RecordBatch:
    """One row per cell: its ids of first words and how many pairs each has, the second words, and counts in a byte
    (a larger count is spread over several entries)."""
    out = {"cell": [], "heads": [], "runs": [], "tails": [], "counts": []}
    for cell, keys, counts in found:
        times = -(-counts // 255)
        keys = np.repeat(keys, times)
        small = np.full(len(keys), 255, dtype=np.uint8)
        small[np.cumsum(times) - 1] = counts - (times - 1) * 255
        heads, each = np.unique(keys >> np.uint64(32), return_counts=True)
        for name, value in zip(out, (cell, heads.astype("<u4").tobytes(), each.astype("<u4").tobytes(),
                                     keys.astype("<u4").tobytes(), small.tobytes())):
            out[name].append(value)
    return pa.RecordBatch.from_arrays(
        [pa.array(out["cell"], pa.int32()), *(pa.array(out[n], pa.binary()) for n in list(out)[1:])], list(out))


def small(counts: np.ndarray) -> np.ndarray:
    """In the narrowest type that holds the largest of them."""
    return counts.astype(np.min_scalar_type(int(counts.max()) if counts.size else 0))


class Files:
    """Mapped arrays of a model, the ones used last."""

    def __init__(self, path: str):
        self.path, self.open = path, {}

    def __getitem__(self, name: str) -> np.ndarray:
        found = self.open.pop(name, None)
        if found is None:
            found = mapped(f"{self.path}/{name}.npy")
            if len(self.open) >= OPEN:
                del self.open[next(iter(self.open))]
        self.open[name] = found
        return found


class Vocabulary:
    """Word hashes in order, in mapped files."""

    def __init__(self, path: str, starts: tuple[int, ...], size: int):
        self.starts, self.size, self.files = np.array(starts, dtype=np.int64), size, Files(path)
        self.edges, self.sizes = shard_edges(len(starts)), np.diff([*starts, size])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes; the vocabulary's size for unknown ones."""
        ids = np.full(len(hashes), self.size, dtype=np.int64)
        for shard, keys, where in by_shard(hashes, np.arange(len(hashes)), self.edges):
            if self.sizes[shard]:
                part = self.files[f"words-{shard}"]
                at = np.minimum(np.searchsorted(part, keys), len(part) - 1)
                ids[where] = np.where(part[at] == keys, at + self.starts[shard], self.size)
        return ids


def shard_edges(shards: int) -> np.ndarray:
    """The least hash of each shard of the vocabulary."""
    return np.array([(s << 64) // shards for s in range(shards)], dtype=np.uint64)


def discounts(n: list[int]) -> list[float]:
    """D for counts 0, 1, 2, 3 and more, from the numbers of entries with counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3) == 0:
        return [0.0, 0.5, 0.75, 0.9]  # too few entries to estimate from
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [0.0, *(float(np.clip(d, 0.05, k)) for k, d in enumerate(found, 1))]


@lru_cache(1)
def opened(path: str, starts: tuple[int, ...], size: int) -> Vocabulary:
    return Vocabulary(path, starts, size)


def fit(docs: DataFrame) -> dict:
    """Count the pairs of all texts and store the model below the shared folder; returns what describes it."""
    spark = docs.sparkSession
    path = new_folder(spark)
    texts = docs.select("text")
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-chars // SHARD_CHARS))
    edges = shard_edges(shards)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held()

        def out():
            found = [(s, k.astype("<u8").tobytes(), c.astype("<i8").tobytes()) for s, k, c in by_shard(*held.take(), edges)]
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()), *(pa.array([f[i] for f in found], pa.binary()) for i in (1, 2))],
                ["shard", "keys", "counts"])

        for part in pieces_of(batches, "text"):
            found, _ = token_hashes(part.column("text"))
            if held.add(*np.unique(found, return_counts=True)):
                yield out()
        yield out()

    def store_words(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        keys, counts = summed(np.concatenate([np.frombuffer(b, "<u8") for b in pdf["keys"]]),
                              np.concatenate([np.frombuffer(b, "<i8") for b in pdf["counts"]]))
        save(f"{path}/words-{shard}.npy", keys)
        save(f"{path}/counts-{shard}.npy", counts)
        return pd.DataFrame({"shard": [shard], "size": [len(keys)], "total": [counts.sum()]})

    kept = {r["shard"]: r for r in texts.mapInArrow(count_words, "shard int, keys binary, counts binary").groupBy(
        "shard").applyInPandas(store_words, "shard int, size bigint, total bigint").collect()}
    sizes = [kept[s]["size"] if s in kept else 0 for s in range(shards)]
    starts = tuple(np.r_[0, np.cumsum(sizes)[:-1]].tolist())
    size, tokens = int(sum(sizes)), int(sum(r["total"] for r in kept.values()))
    model = {"path": path, "starts": starts, "size": size, "tokens": tokens, "shards": shards}
    if not size:
        return model | {"pair": [0.0] * 4, "single": [0.0] * 4, "singles": [0] * 4}
    if size >> 32:
        raise ValueError(f"{size} different words: ids of pairs hold 2^32")
    ids_at = np.array(starts, dtype=np.int64)
    ends = np.r_[starts[1:], size]
    cells = Cells(starts, [kept[s]["total"] if s in kept else 0 for s in range(shards)])
    model["cells"] = cells

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, held = opened(path, starts, size), Held()
        end = vocabulary.find(np.array([END], dtype=np.uint64))
        for part in pieces_of(batches, "text", BLOCK):
            words, at = dense(token_hashes(part.column("text"))[0])
            if len(at):
                ids = vocabulary.find(words).astype(np.uint64)[at]
                key = np.r_[end.astype(np.uint64), ids[:-1]] << np.uint64(32) | ids
                if held.add(*np.unique(key, return_counts=True)):
                    yield rows_of(cells.dealt(*held.take()))
        yield rows_of(cells.dealt(*held.take()))

    def store_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        cell = int(pdf["cell"].iloc[0])
        shard = cells.shard(cell)
        keys = [np.repeat(np.frombuffer(h, "<u4").astype(np.uint64) << np.uint64(32), np.frombuffer(r, "<u4"))
                | np.frombuffer(t, "<u4") for h, r, t in zip(pdf["heads"], pdf["runs"], pdf["tails"])]
        keys, counts = summed(np.concatenate(keys), np.concatenate([np.frombuffer(c, np.uint8) for c in pdf["counts"]])
                              .astype(np.int64))
        save(f"{path}/keys-{cell}.npy", keys)
        save(f"{path}/pairs-{cell}.npy", small(counts))
        heads, place = dense((keys >> np.uint64(32)).astype(np.int64) - starts[shard])
        each = np.stack([np.bincount(place, weights=w, minlength=len(heads)).astype(np.int64)
                         for w in (counts, counts == 1, counts == 2, counts > 2)], axis=1)
        out = [(-1, b"", b"", b"", b"", [*np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist(), cell])]
        if cells.parts[shard] > 1:  # other cells have more of these contexts
            out.append((shard, b"", b"", heads.astype("<u4").tobytes(), each.astype("<i8").tobytes(), [0] * 4))
        else:
            save_contexts(shard, heads, each)
        words, before = np.unique((keys & LOW).astype(np.int64), return_counts=True)
        out += [(s, k.astype("<u4").tobytes(), c.astype("<u4").tobytes(), b"", b"", [0] * 4)
                for s, k, c in by_shard(words, before, ids_at)]
        return pd.DataFrame(out, columns=["shard", "ids", "before", "heads", "contexts", "n"])

    def save_contexts(shard: int, heads: np.ndarray, each: np.ndarray) -> None:
        found = np.zeros((int(ends[shard] - starts[shard]), 4), dtype=np.int64)
        np.add.at(found, heads, each)
        save(f"{path}/contexts-{shard}.npy", small(found))

    def store_before(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        total = np.zeros(int(ends[shard] - starts[shard]), dtype="<u4")
        for ids, before in zip(pdf["ids"], pdf["before"]):
            total[np.frombuffer(ids, "<u4").astype(np.int64) - starts[shard]] += np.frombuffer(before, "<u4")
        if cells.parts[shard] > 1:
            save_contexts(shard, np.concatenate([np.frombuffer(h, "<u4") for h in pdf["heads"]]),
                          np.concatenate([np.frombuffer(c, "<i8").reshape(-1, 4) for c in pdf["contexts"]]))
        save(f"{path}/before-{shard}.npy", total)
        numbers = np.bincount(np.minimum(total, 5).astype(np.int64), minlength=6)
        return pd.DataFrame({"n": [[*numbers[1:5].tolist(), int((total > 2).sum()), int(total.sum(dtype=np.int64))]]})

    counted = cut_lineage(texts.mapInArrow(
        count_pairs, "cell int, heads binary, runs binary, tails binary, counts binary").groupBy("cell").applyInPandas(
        store_pairs, "shard int, ids binary, before binary, heads binary, contexts binary, n array<bigint>"))
    numbers = np.array([r["n"] for r in counted.where("shard < 0").select("n").collect()])
    model["stored"] = frozenset(numbers[:, 4].tolist())
    pair = numbers[:, :4].sum(axis=0)
    single = np.sum([r["n"] for r in counted.where("shard >= 0").groupBy("shard").applyInPandas(
        store_before, "n array<bigint>").collect()], axis=0)
    n1, n2, _, _, n3, total = single.tolist()
    return model | {"pair": discounts(pair.tolist()), "single": discounts(single.tolist()[:4]),
                    "singles": [n1, n2, n3, total]}


class Scorer:
    def __init__(self, model: dict):
        self.model, self.cells = model, model["cells"]
        self.vocabulary = opened(model["path"], model["starts"], model["size"])
        self.files = self.vocabulary.files
        self.pair, self.single = np.array(model["pair"]), np.array(model["single"])
        n1, n2, n3, total = model["singles"]
        self.left = (self.single[1] * n1 + self.single[2] * n2 + self.single[3] * n3) / max(1, total)

    def per_word(self, ids: np.ndarray, name: str, columns: int = 0) -> np.ndarray:
        """Entries of a file of the vocabulary's shape for ids; those known are in order, the unknown word has 0."""
        out = np.zeros((len(ids), columns) if columns else len(ids), dtype=np.int64)
        known = np.flatnonzero(ids < self.model["size"])
        for shard, keys, where in by_shard(ids[known], known, self.cells.starts):
            out[where] = self.files[f"{name}-{shard}"][keys - self.cells.starts[shard]]
        return out

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of pairs of ids; those known are in order."""
        out = np.zeros(len(first), dtype=np.int64)
        known = np.flatnonzero((first < self.model["size"]) & (second < self.model["size"]))
        keys = first[known].astype(np.uint64) << np.uint64(32) | second[known].astype(np.uint64)
        for cell, sought, where in self.cells.dealt(keys, known):
            if cell not in self.model["stored"]:
                continue
            part = self.files[f"keys-{cell}"]
            at = np.minimum(np.searchsorted(part, sought), len(part) - 1)
            hit = part[at] == sought
            out[where[hit]] = self.files[f"pairs-{cell}"][at[hit]]
        return out

    def scores(self, texts: pa.Array):
        """Per text: numbers of tokens and of known tokens, base score and score."""
        model = self.model
        found, sizes = token_hashes(texts)
        words, at = dense(found)
        ids = self.vocabulary.find(words)
        counts = self.per_word(ids, "counts")
        base = np.log10((counts + 1) / (model["tokens"] + model["size"] + 1))
        before = self.per_word(ids, "before")
        total = max(1, model["singles"][3])
        alone = (before - self.single[np.minimum(before, 3)]) / total + self.left / (model["size"] + 1)
        c, n1, n2, n3 = self.per_word(ids, "contexts", 4).T
        rest = np.where(c > 0, (self.pair[1] * n1 + self.pair[2] * n2 + self.pair[3] * n3) / np.maximum(c, 1), 1.0)
        first = np.r_[np.searchsorted(words, np.uint64(END)), at[:-1]]
        pairs, place = dense(first * len(words) + at)
        head, tail = np.divmod(pairs, len(words))
        seen = self.pair_counts(ids[head], ids[tail])
        chance = (seen - self.pair[np.minimum(seen, 3)]) / np.maximum(c, 1)[head] + rest[head] * alone[tail]
        edges = np.r_[0, np.cumsum(sizes)[:-1]]
        add = lambda x: np.add.reduceat(x, edges)
        return sizes, add((counts > 0).astype(np.int64)[at]), add(base[at]), add(np.log10(chance)[place])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score and perplexity of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(model) if model["size"] else None
        for part in pieces_of(batches, "text", BLOCK):
            texts = part.column("text")
            if own:
                sizes, known, base, found = own.scores(texts)
            else:
                sizes = token_hashes(texts)[1]
                known, base, found = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(base),
                 pa.array(found), pa.array(10.0 ** np.minimum(-found / sizes, 300))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double")


def op9_kneser_ney(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 7) == 2
    model = fit(docs.where(~held))
    scored = stored(score(docs, model))
    drop_folder(spark, model["path"])  # the model is read no more
    return scored.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("bigint").alias("train_tokens"),
        "base_score", "score", "perplexity")
