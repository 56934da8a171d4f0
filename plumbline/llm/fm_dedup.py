"""Removal of repeated passages with a compressed FM-index per shard (operator 5).

A window is WINDOW consecutive words of a document; words covered by a window whose word sequence also starts earlier
(in document order, then position) are removed.

1. Anchors. Of the GRAM-word hashes in a window the least one is its anchor. Equal windows have equal anchors, and
   windows in a row that share theirs form a stretch, so text is dealt to shards by anchor without losing a match.
   An anchor that stands once in the corpus has no equal window: only stretches of repeated anchors go on.
2. Of equal texts only the first sends stretches. Stretches of equal words are merged before the shuffle to the earliest
   one; only that can hold a window that is the first of its kind, so all later ones are covered as a whole. An anchor
   with very many different stretches (a large group of near copies) or very many words (long periodic texts) is cut into
   single windows, dealt by their own hash.
3. Each shard lays its stretches end to end in document order and builds an FM-index: the Burrows-Wheeler transform in a
   wavelet matrix of packed bits with rank counts, and the positions of the suffixes in 32 bits. The stretches are then streamed
   against it: for each window's end, backward search extends the match word by word while another place matches
   (matching statistics up to WINDOW). Windows whose match reaches WINDOW report their interval; the earliest place in
   it is the window's first.
4. Windows found to be first are sent back to their documents; all other windows of repeated anchors are covered.

Stretches travel as the texts they are. Words are told apart by 64-bit hashes, in shards too.

Rows: a null text has no words; a repeated or null doc_id makes
separate documents (null first; rows of one id by file and place); texts shorter than a window are kept whole. A very
long text is a block of its own, and so is held by a task with its words; its stretches go to many shards. Extra columns
come through whatever they are called; an empty table gives an empty one.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import BLOCK_BYTES, neutral, pieces_of, rows_numbered, running_total, table
from plumbline.llm.word_hashes import MIX, Words, hashed, mixed
from plumbline.session import drop_folder, new_folder, release, stored

WINDOW, GRAM = 20, 8
SHARD_WORDS, VARIANTS = 600_000, 5_000
CUT = 20_000  # windows that are made at a time


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out = out * MIX + hashes[i:i + n]
    return mixed(out)


class Stretches:
    """Of texts laid end to end: the runs of windows with one anchor."""

    def __init__(self, texts: pa.Array, window: int, gram: int):
        self.words = Words(texts)
        self.hashes, self.sizes = self.words.hashes(), self.words.sizes
        self.start = np.cumsum(self.sizes) - self.sizes
        self.windows = np.maximum(self.sizes - window + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), self.windows)
        # Where windows that lie in one text begin.
        self.at = self.start[self.doc] + np.arange(len(self.doc)) - (np.cumsum(self.windows) - self.windows)[self.doc]
        self.gram = grams(self.hashes, gram)
        least, self.span, width = self.gram, window - gram + 1, 1
        while 2 * width <= self.span:  # least of 2, 4, 8, ... neighbours
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < self.span:
            more = self.span - width
            least = np.minimum(least[:len(least) - more], least[more:])
        least = least[self.at] if len(self.at) else self.gram[:0]
        new = np.r_[True, (least[1:] != least[:-1]) | (self.doc[1:] != self.doc[:-1])] if len(least) else []
        self.first = np.flatnonzero(new)  # among the windows
        self.anchor = least[self.first]
        self.count = np.diff(np.r_[self.first, len(least)])
        own = np.bincount(self.doc[self.first], minlength=len(texts)) if len(least) else np.zeros(len(texts), np.int64)
        self.base = np.cumsum(own) - own  # number of the first stretch of each text

    def numbers(self) -> np.ndarray:
        """Which stretch of its text each is."""
        return np.arange(len(self.first)) - self.base[self.doc[self.first]]

    def times(self) -> np.ndarray:
        """In how many places of its stretch an anchor stands: periodic text may repeat a window within a stretch."""
        width = self.count + self.span - 1
        if not len(width):
            return width
        begin = np.cumsum(width) - width
        place = np.repeat(self.at[self.first] - begin, width) + np.arange(width.sum())
        return np.add.reduceat((self.gram[place] == np.repeat(self.anchor, width)).astype(np.int64), begin)

    def repeated(self, alone: pa.ListArray) -> np.ndarray:
        """Which stretches have a repeated anchor, from the numbers of the others in each text."""
        text = np.repeat(np.arange(len(alone)), alone.value_lengths().fill_null(0).to_numpy())
        out = np.ones(len(self.first), dtype=bool)
        out[self.base[text] + alone.flatten().to_numpy(zero_copy_only=False).astype(np.int64)] = False
        return out


class WaveletMatrix:
    """Ranks of symbols in a sequence: one packed bit vector per bit of a symbol, each stably sorted by the one above."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        current = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = (current >> level & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, dtype=bool)
            padded[:len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(words))].astype(np.int64))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[~bit], current[bit]])

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """How many of each symbol stand before low and before high (arrays)."""
        begin = np.zeros_like(low)
        for words, counts, zeros, level in zip(self.words, self.counts, self.zeros, range(self.depth - 1, -1, -1)):
            ones = []
            for at in (begin, low, high):
                word = at >> 6
                below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
                ones.append(counts[word] + np.bitwise_count(words[word] & below))
            set_ = (symbols >> level & 1).astype(bool)
            begin, low, high = (np.where(set_, zeros + one, at - one) for at, one in zip((begin, low, high), ones))
        return low - begin, high - begin


class FmIndex:
    """Index of stretches laid end to end, for matches of at most ``window`` words."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, window: int):
        values, symbols = np.unique(hashes, return_inverse=True)
        start = np.cumsum(sizes) - sizes
        # Symbol 0 ends each stretch and is in no query.
        text = np.zeros(len(hashes) + len(sizes), dtype=np.int64)
        shift = np.repeat(np.arange(len(sizes)), sizes)
        text[np.arange(len(hashes)) + shift] = symbols + 1
        self.start, self.text, self.window = start + np.arange(len(sizes)), text, window
        # Order of suffixes by their first ``known`` words (at least window + 1), ties by position.
        rank, known = text.copy(), 1
        while known <= window:
            ahead = np.zeros_like(rank)
            ahead[:-known] = rank[known:] + 1
            both = rank * (int(rank.max()) + 2) + ahead
            self.suffixes = np.argsort(both, kind="stable")
            ordered = both[self.suffixes]
            rank = np.empty_like(rank)
            rank[self.suffixes] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
            known *= 2
        self.suffixes = self.suffixes.astype(np.uint32)
        self.wavelet = WaveletMatrix(text[self.suffixes.astype(np.int64) - 1], len(values) + 1)
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=len(values) + 1))]

    def matches(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For windows by the positions of their last words: length of the longest match that ends there and has
        another place (up to the window), and the interval of suffixes that start with it."""
        length = np.zeros(len(last), dtype=np.int64)
        low, high = np.zeros(len(last), dtype=np.int64), np.full(len(last), len(self.text), dtype=np.int64)
        alive = np.arange(len(last))
        for step in range(self.window):
            symbol = self.text[last[alive] - step]
            less, more = self.wavelet.ranks(symbol, low[alive], high[alive])
            less, more = less + self.before[symbol], more + self.before[symbol]
            twice = more - less > 1
            alive = alive[twice]
            low[alive], high[alive], length[alive] = less[twice], more[twice], step + 1
        return length, low, high


def first_windows(window: int):
    """Of a shard's stretches: the windows that stand first, as runs (document, first window, number)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", kind="stable")
        hashes, sizes = hashed(pa.array(pdf["content"], pa.large_binary()))
        index = FmIndex(hashes, sizes, window)
        count = sizes - window + 1
        own = np.repeat(index.start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        length, low, high = index.matches(own + window - 1)
        found = np.flatnonzero(length == window)
        earliest = own.copy()
        if len(found):
            # Windows of equal words share one interval; its earliest place is the least position in it.
            lows, at = np.unique(low[found], return_index=True)
            edges = np.stack([lows, high[found][at]], axis=1).ravel()
            least = np.minimum.reduceat(np.r_[index.suffixes, 0], edges)[::2]
            earliest[found] = least[np.searchsorted(lows, low[found])]
        first = earliest == own
        stretch = np.repeat(np.arange(len(sizes)), count)
        place = own - index.start[stretch]
        edge = first & np.r_[True, ~first[:-1] | (stretch[1:] != stretch[:-1])]
        begin = np.flatnonzero(edge)
        run_of = np.cumsum(edge) - 1
        numbers = np.bincount(run_of[first], minlength=len(begin)) if len(begin) else np.zeros(0, np.int64)
        pos = pdf["pos"].to_numpy()[stretch[begin]] + place[begin]
        return pd.DataFrame({"pos": pos, "n": numbers})

    return run


def squeezed(rows: DataFrame) -> DataFrame:
    """The same rows with ``text`` as compressed bytes, so that a shuffle of whole texts moves and stores less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in pieces_of(batches, "text"):
            small = pa.array([None if t is None else squeeze(t.encode("utf-8", "surrogatepass"))
                              for t in part.column("text").to_pylist()], pa.binary())
            yield part.set_column(part.schema.get_field_index("text"), "text", small)

    kinds = ", ".join(f"{f.name} {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, kinds)


def unsqueezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Undo ``squeezed``, some rows at a time."""
    expand = zstandard.ZstdDecompressor().decompress
    for part in pieces_of(batches, "text", BLOCK_BYTES // 3):
        full = [None if t is None else expand(t).decode("utf-8", "surrogatepass")
                for t in part.column("text").to_pylist()]
        yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(full, pa.string()))


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """_row, _ord (place in document order), ``size`` (bytes of text) and ``new`` (no earlier row has the same
    text, by its SHA-256) of each row, and the number of rows."""
    rows = docs.select("doc_id", "_row", F.lit(1).alias("_one"), F.octet_length("text").alias("size"),
                       F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("_digest"))
    placed, total = running_total(rows, ["doc_id", "_row"], "_one", "_ord")
    first = placed.groupBy("_digest").agg(F.min("_ord").alias("_ord")).select("_ord", F.lit(True).alias("_new"))
    return placed.join(first, "_ord", "left").select(
        "_row", "_ord", "size", F.col("_new").isNotNull().alias("new")), total


def spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """_row, ``alone`` (numbers of the document's stretches whose anchor stands once) and ``firsts`` (runs of windows
    that stand first although their anchor is repeated): what ``removed`` needs besides the texts. ``docs`` has _row."""
    texts = docs.select("_row", "text")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, "text"):
            found = Stretches(part.column("text"), window, gram)
            rows = part.column("_row").to_numpy()[found.doc[found.first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(found.numbers(), pa.int32()), pa.array(found.anchor.view(np.int64)),
                 pa.array(found.times(), pa.int32())], ["_row", "k", "anchor", "n"])

    # Of an anchor that stands once, the least row and the least number are those of its only stretch.
    once = texts.mapInArrow(anchors, "_row bigint, k int, anchor bigint, n int").groupBy("anchor").agg(
        F.sum("n").alias("n"), F.min("_row").alias("_row"), F.min("k").alias("k")).where("n = 1")
    alone = once.groupBy("_row").agg(F.collect_list("k").alias("alone"))
    places, total = numbered(docs)
    folders = [new_folder(docs.sparkSession)]
    alone = stored(places.join(alone, "_row", "left"), folders[0])
    # A position is the document's number and, below ``shift`` bits, the word's: a text has at most size / 2 + 1 words.
    longest = alone.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
    shift = (longest // 2 + 1).bit_length()
    if total.bit_length() + shift > 63:
        raise ValueError(f"{total} documents of up to {longest} bytes: positions hold 63 bits")
    release(docs.sparkSession)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unsqueezed(batches):
            seen: dict[bytes, tuple[int, int, int]] = {}
            found = Stretches(part.column("text"), window, gram)
            number, whole = part.column("_ord").to_numpy(), found.words.padded.tobytes()
            some = np.flatnonzero(found.repeated(part.column("alone")))
            at = found.at[found.first[some]]
            doc = found.doc[found.first[some]]
            pos = (number[doc] << shift) + at - found.start[doc]
            size = found.count[some] + window - 1
            for anchor, a, b, n, place in zip(
                    found.anchor.view(np.int64)[some].tolist(), found.words.begin[at].tolist(),
                    found.words.end[at + size - 1].tolist(), size.tolist(), pos.tolist()):
                content = whole[a:b]
                if content not in seen or place < seen[content][1]:
                    seen[content] = anchor, place, n
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _, _ in seen.values()], pa.int64()), pa.array(list(seen), pa.binary()),
                 pa.array([p for _, p, _ in seen.values()], pa.int64()),
                 pa.array([n for _, _, n in seen.values()], pa.int64())], ["anchor", "content", "pos", "n"])

    # All windows of a copy stand earlier, so only the first of equal texts has stretches to send.
    parts = squeezed(texts).join(alone.where("new"), "_row").select("_ord", "text", "alone").mapInArrow(
        repeated, "anchor bigint, content binary, pos bigint, n bigint").groupBy("anchor", "content").agg(
        F.min("pos").alias("pos"), F.max("n").alias("n"))
    folders.append(new_folder(docs.sparkSession))
    parts = stored(parts, folders[-1])
    release(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, pos in zip(batch.column("content").to_pylist(), batch.column("pos").to_pylist()):
                words = content.split()
                hashes = hashed(pa.array([content], pa.binary()))[0]
                for i in range(0, len(hashes) - window + 1, CUT):
                    key = grams(hashes[i:i + CUT + window - 1], window).view(np.int64)
                    place = np.arange(i, i + len(key))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array([b" ".join(words[k:k + window]) for k in place.tolist()], pa.binary()),
                         pa.array(pos + place), pa.array(np.full(len(key), window))], ["anchor", "content", "pos", "n"])

    many = parts.groupBy("anchor").agg(F.count("*").alias("times"), F.sum("n").alias("words")).where(
        (F.col("times") > VARIANTS) | (F.col("words") > SHARD_WORDS)).select("anchor")
    if not many.isEmpty():
        single = parts.join(many, "anchor", "left_semi").select("anchor", "content", "pos").mapInArrow(
            cut, "anchor bigint, content binary, pos bigint, n bigint").groupBy("anchor", "content").agg(
            F.min("pos").alias("pos"), F.max("n").alias("n"))
        folders.append(new_folder(docs.sparkSession))
        parts = stored(parts.join(many, "anchor", "left_anti").select("anchor", "content", "pos", "n").unionByName(single),
                       folders[-1])
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = parts.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "content", "pos")
    found = dealt.groupBy("shard").applyInPandas(first_windows(window), "pos bigint, n bigint")
    firsts = found.groupBy(F.expr(f"shiftright(pos, {shift})").alias("_ord")).agg(
        F.collect_list(F.struct(F.expr(f"pos & {(1 << shift) - 1}").alias("at"), "n")).alias("firsts"))
    result = stored(alone.join(firsts, "_ord", "left").select("_row", "alone", "firsts"))
    release(docs.sparkSession)
    for folder in folders:  # these tables are read no more
        drop_folder(docs.sparkSession, folder)
    return result


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The columns of ``docs`` but for text, in a struct ``row``, with n_words, n_removed and ``kept``: the text as it
    was if nothing is removed, else the words left, joined by one space, as bytes; ``kept_words`` is joined always."""
    given, names = neutral(docs)
    row = F.struct(*(n for c, n in names.items() if c != "text"))
    docs = rows_numbered(given)
    found = spans(docs, window, gram)
    kind = docs.select(row.alias("row")).schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unsqueezed(batches):
            given = part.column("text").to_pylist()
            words = [words_of(t) for t in given]
            found = Stretches(part.column("text"), window, gram)
            covered = np.repeat(found.repeated(part.column("alone")), found.count)
            base = np.cumsum(found.windows) - found.windows
            firsts = part.column("firsts")
            runs = firsts.flatten()
            if len(runs):
                doc = np.repeat(np.arange(len(given)), firsts.value_lengths().fill_null(0).to_numpy())
                begin, n = base[doc] + runs.field("at").to_numpy(), runs.field("n").to_numpy()
                covered[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())] = False
            edges = np.zeros(len(found.hashes) + window + 1, dtype=np.int32)
            edges[found.at[covered]] += 1
            edges[found.at[covered] + window] -= 1
            gone = np.cumsum(edges[:len(found.hashes)]) > 0
            before = np.r_[0, np.cumsum(gone)]
            losses = before[found.start + found.sizes] - before[found.start]
            texts, kept = [], []
            for text, ws, a, loss in zip(given, words, found.start.tolist(), losses.tolist()):
                if loss:
                    ws = list(compress(ws, (~gone[a:a + len(ws)]).tolist()))
                kept.append(b" ".join(ws))
                texts.append(kept[-1] if loss else None if text is None else text.encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(found.sizes), pa.array(losses), pa.array(texts, pa.binary()),
                 pa.array(kept, pa.binary())], ["row", "n_words", "n_removed", "kept", "kept_words"])

    texts = docs.select("_row", row.alias("row"), "text")
    result = squeezed(texts).join(found, "_row").select("row", "text", "alone", "firsts").mapInArrow(
        run, f"row {kind}, n_words bigint, n_removed bigint, kept binary, kept_words binary")
    as_given = F.struct(*(F.col(f"row.{n}").alias(c) for c, n in names.items() if c != "text"))
    return result.select(as_given.alias("row"), "n_words", "n_removed", "kept", "kept_words")


def op5_fm_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return removed(docs).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM win)
  WHERE n > 1
), gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
word AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d),
left_over AS (
  SELECT word.doc_id, count(gone.p) AS n_removed,
         coalesce(string_agg(CASE WHEN gone.p IS NULL THEN x END, ' ' ORDER BY word.p), '') AS t
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""
