"""Phrase collocation mining by partitions (SON).

Words and phrases are counted by language. A phrase of a language's ``n`` words that occurs ``support`` times must occur
``support * m / n`` times in at least one of any shards that these words are dealt to, where m are the shard's words.

1. The words of each language are counted.
2. A task's documents are a shard of some ``SHARD_WORDS`` words. Each shard is mined completely, level by level,
   at its proportionally lowered support: a run of k + 1 words can only be frequent where both its runs of k are. The
   shards' phrases of 1 to ``LONGEST`` words together are the candidates, less those whose counts, with the most that
   the other shards can have left out, don't reach the support.
3. All occurrences of all candidates are counted, exactly and by their text. A filter over the candidates' hashes, its
   size set by their counted number up to ``FILTER_BITS``, keeps other phrases from being shuffled; one that it lets
   through is counted right as well, and is no more frequent for that.
4. Every cut of a frequent phrase meets the counts of its two parts, which are at least as frequent. The scores are exact
   decimals. Phrases that lie inside a longer one of the same count are dropped, and each language is ranked.

Shards are as few as parallel work and a task's memory allow, since with more shards than ``support`` the lowered
support is one and mining rules nothing out (some 2.4 billion words at 100 occurrences); counts stay exact there, but
step 3 shuffles more. Counts are combined in a task before they are shuffled, so that a phrase in most documents costs
one row a task, and a language's candidates are never in one place: ranking keeps the first ``top`` of each task first.

Defined results: a null or empty text has no words; documents without language are of ``und``, together with those that
say so; repeated rows count as often as they occur; equal scores go by count, then by the phrase's bytes; a long text is
read whole; ids and further columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import map_arrow, stored
from vaultline.llm.components import bits_of, has_bit

#: Least count of a candidate, words in the longest one, phrases reported by language.
SUPPORT = 100
LONGEST = 5
TOP = 2000

#: Bytes that end a piece, and bytes of words once A-Z are lower-cased.
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORDS = ~BREAKS
WORDS[[0x20, 0x09]] = False

#: Words of a shard as they are dealt, and the most that a task holds before it begins another.
SHARD_WORDS, MOST_WORDS = 24_000_000, 36_000_000
PASS = 2_000_000
LEAST_SHARDS = 16
FILTER_BITS = 27
BLOCK = 1 << 20
HELD = 1_500_000


class Words:
    """A lower-cased chunk's words: their bytes' ranges, hashes, documents, and whether the next is in the same piece."""

    def __init__(self, chunk: T.Chunk):
        self.chunk = chunk.lower()
        self.starts, self.ends, first = self.chunk.runs(WORDS)
        self.doc = T.doc_of(first)
        self.hashes = self.chunk.hashes(self.starts, self.ends)
        piece = np.searchsorted(np.flatnonzero(BREAKS[self.chunk.data]), self.starts)
        self.joined = np.zeros(len(self.starts), bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])

    def phrase(self, at: int, n: int) -> bytes:
        data = self.chunk.data
        return b" ".join(data[a:b].tobytes() for a, b in zip(self.starts[at: at + n].tolist(), self.ends[at: at + n].tolist()))


def longer(alive: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Marks the runs of one word more whose two shorter runs are marked and in one piece, given ``joined`` of the
    first run's first word: runs of k words in one piece overlap, so only the first step can leave it."""
    out = np.zeros(len(alive), bool)
    out[:-1] = alive[:-1] & alive[1:] & joined[:-1]
    return out


def hashes_at(words: np.ndarray, at: np.ndarray, n: int, salt: int | np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``n`` words that begin at some places, told apart by a salt (a language's, or each place's)."""
    out = np.full(len(at), 1, T.U64) * (np.asarray(salt, T.U64) * T.U64(8) + T.U64(n))
    for k in range(n):
        out = T.mix(out * T.U64(0x9E3779B97F4A7C15) + words[at + k])
    return out


def codes(hashes: np.ndarray) -> np.ndarray:
    """Words as 32 bits, in which shards hold them. Words alike in these only add candidates."""
    return (hashes >> T.U64(32)).astype(np.uint32)


def joined_up(parts: list[np.ndarray]) -> np.ndarray:
    """The parts in one array. Each is let go as it is copied, so that no shard is held twice."""
    out = np.empty(sum(map(len, parts)), parts[0].dtype)
    end = len(out)
    while parts:
        part = parts.pop()
        out[end - len(part): end] = part
        end -= len(part)
    return out


def mine(words: np.ndarray, joined: np.ndarray, support: int, salt: int, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of all runs of up to ``longest`` words of a shard that occur ``support`` times. Runs are
    counted in passes over ranges of their hashes, ``PASS`` or so at a time."""
    alive, kinds, times = np.ones(len(words), bool), [], []
    for n in range(1, longest + 1):
        if n > 1:
            alive = longer(alive, joined)
        passes, left = T.U64(max(1, -(-int(np.count_nonzero(alive)) // PASS))), alive.copy()
        any_frequent = False
        for number in range(int(passes)):
            at, hashes = [], []
            for k in range(0, len(alive), BLOCK):
                some = np.flatnonzero(alive[k: k + BLOCK]).astype(np.int32) + np.int32(k)
                found = hashes_at(words, some, n, salt)
                mine_ = found % passes == T.U64(number)
                at.append(some[mine_])
                hashes.append(found[mine_])
            at, hashes = (joined_up(x) if x else np.zeros(0, t) for x, t in ((at, np.int32), (hashes, T.U64)))
            ordered = np.sort(hashes)
            frequent = np.unique(ordered[support - 1:][ordered[support - 1:] == ordered[: len(ordered) - support + 1]]) if len(ordered) >= support else ordered[:0]
            kinds.append(frequent)
            times.append(np.searchsorted(ordered, frequent, "right") - np.searchsorted(ordered, frequent))
            any_frequent |= len(frequent) > 0
            del ordered
            for k in range(0, len(at) if support > 1 else 0, BLOCK):
                some = hashes[k: k + BLOCK]
                ok = frequent[np.minimum(np.searchsorted(frequent, some), len(frequent) - 1)] == some if len(frequent) else np.zeros(len(some), bool)
                left[at[k: k + BLOCK][~ok]] = False
        alive = left
        if not any_frequent:
            break
    return np.concatenate(kinds), np.concatenate(times)


def by_language(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))


def word_totals(docs: DataFrame) -> DataFrame:
    """``lang, n``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes = np.concatenate([np.diff(c.runs(WORDS)[2]) for c in T.chunks(part.column("text"))]) if len(part) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(sizes.astype(np.int64))], ["lang", "n"])

    return map_arrow(docs, run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def salts(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Each document's language as a number below the number of languages in the batch, and their salts."""
    coded = part.column("lang").dictionary_encode()
    names = [x.encode() for x in coded.dictionary.to_pylist()]
    chunk = T.Chunk.of(names)
    return coded.indices.to_numpy(), chunk.hashes(chunk.offsets[:-1], chunk.offsets[1:]) if names else np.zeros(0, T.U64)


def local_candidates(docs: DataFrame, support: int, longest: int) -> DataFrame:
    """``h, salt, over``: hashes of the phrases that are frequent in some shard, by language, and by how much their
    counts exceed what the shard would have left out; with a null ``h``, that largest count left out itself. ``docs``
    carry their language's words as ``n``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            while held:
                salt, (total, words, joined) = held.popitem()
                words, joined = joined_up(words), joined_up(joined)
                lowered = max(1, -(-support * len(words) // total))
                h, times = mine(words, joined, lowered, salt, longest)
                h, over = pa.array(h.view(np.int64)), pa.array(times - (lowered - 1))
                signed = np.full(len(h) + 1, salt, T.U64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([h, pa.nulls(1, pa.int64())]), pa.array(signed), pa.concat_arrays([over, pa.array([lowered - 1])])], ["h", "salt", "over"]
                )

        for part in parts:
            code, salt = salts(part)
            totals = part.column("n").to_numpy()
            for chunk in T.chunks(part.column("text")):
                found = Words(chunk)
                lang = code[chunk.first + found.doc]
                for c in np.unique(lang).tolist():
                    of_lang = lang == c
                    entry = held.setdefault(int(salt[c]), [int(totals[np.argmax(code == c)]), [], []])
                    entry[1].append(codes(found.hashes[of_lang]))
                    entry[2].append(found.joined[of_lang])
                size += len(found.starts)
                if size >= MOST_WORDS:
                    yield from flush()
                    size = 0
        yield from flush()

    return map_arrow(docs, run, "h long, salt long, over long")


def candidates(docs: DataFrame, support: int, longest: int) -> DataFrame:
    """``h``: the locally frequent phrases that can be frequent in all: where a phrase is not listed, its count is at
    most the largest that the shard left out."""
    local = stored(local_candidates(docs, support, longest), "local-candidates")
    left_out = local.where("h is null").groupBy("salt").agg(F.sum("over").alias("left_out"))
    return local.where("h is not null").groupBy("h", "salt").agg(F.sum("over").alias("over")).join(left_out, "salt").where(F.col("over") + F.col("left_out") >= support).select("h")


class Tally:
    """Counts of phrases by hash, each with its text and language, in a few plain arrays."""

    def __init__(self):
        self.hashes, self.slots, self.counts = np.zeros(0, T.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.texts, self.ends, self.words, self.langs = bytearray(), array("q"), array("b"), []

    def __len__(self) -> int:
        return len(self.ends)

    def add(self, kinds: np.ndarray, times: np.ndarray, describe: Callable[[int], tuple[bytes, int, str]]) -> None:
        """``kinds`` ascend and do not repeat; ``describe`` gives text, words and language of the k-th, if it is new."""
        at = np.minimum(np.searchsorted(self.hashes, kinds), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == kinds if len(self.hashes) else np.zeros(len(kinds), bool)
        self.counts[self.slots[at[known]]] += times[known]
        fresh = np.flatnonzero(~known)
        for k in fresh.tolist():
            text, words, lang = describe(k)
            self.texts += text
            self.ends.append(len(self.texts))
            self.words.append(words)
            self.langs.append(lang)
        slots = np.arange(len(self.counts), len(self.counts) + len(fresh))
        self.counts = np.concatenate([self.counts, times[fresh]])
        merged = np.concatenate([self.hashes, kinds[fresh]])
        order = np.argsort(merged, kind="stable")
        self.hashes, self.slots = merged[order], np.concatenate([self.slots, slots])[order]

    def batches(self) -> Iterator[pa.RecordBatch]:
        data, ends = bytes(self.texts), [0, *self.ends]
        for a in range(0, len(self), 50_000):
            b = min(len(self), a + 50_000)
            phrases = pa.array([data[x:y].decode() for x, y in zip(ends[a:b], ends[a + 1: b + 1])], pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.langs[a:b], pa.string()), phrases, pa.array(self.words[a:b], pa.int32()), pa.array(self.counts[a:b])],
                ["lang", "phrase", "words", "a"],
            )


def occurrences(docs: DataFrame, filter_: np.ndarray, longest: int) -> DataFrame:
    """``lang, phrase, words, a``: counts, by task, of the phrases that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, tally = shared.value, Tally()
        for part in parts:
            code, salt = salts(part)
            langs = part.column("lang").to_pylist()
            for chunk in T.chunks(part.column("text")):
                found = Words(chunk)
                doc, alive = chunk.first + found.doc, np.ones(len(found.starts), bool)
                word_salt, coded = salt[code[doc]], codes(found.hashes)
                for n in range(1, longest + 1):
                    if n > 1:
                        alive = longer(alive, found.joined)
                    at = np.flatnonzero(alive)
                    passed = has_bit(bits, hashes_at(coded, at, n, word_salt[at]))
                    alive[at[~passed]] = False
                    at = at[passed]
                    kinds, first, times = np.unique(hashes_at(found.hashes, at, n, word_salt[at]), return_index=True, return_counts=True)
                    where = at[first]
                    tally.add(kinds, times, lambda k: (found.phrase(int(where[k]), n), n, langs[int(doc[where[k]])]))  # noqa: B023
                if len(tally) > HELD:
                    yield from tally.batches()
                    tally = Tally()
        yield from tally.batches()

    return map_arrow(docs, run, "lang string, phrase string, words int, a long")


def frequent_phrases(docs: DataFrame, totals: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, words, a``: all phrases of 1 to ``longest`` words with their exact counts, if at least
    ``support``. ``docs`` as from ``by_language``, ``totals`` as from ``word_totals``."""
    spark = docs.sparkSession
    known = totals.where(F.col("n") >= support)
    total = known.agg(F.sum("n")).first()[0] or 0
    shards = max(-(-total // SHARD_WORDS), min(LEAST_SHARDS, spark.sparkContext.defaultParallelism))
    dealt = docs.join(known, "lang").coalesce(shards)
    union = stored(candidates(dealt, support, longest), "candidates")
    log_bits = min(FILTER_BITS, max(16, int(16 * union.count()).bit_length()))
    counted = occurrences(dealt, bits_of(union, log_bits), longest)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= support)


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of the phrases of two words or more, by their lowest cut."""
    big = "decimal(19,0)"
    words = F.split("phrase", " ")
    cuts = frequent.where("words > 1").select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    left = frequent.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    met = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    product = f"cast(1000 * cast(a as {big}) as decimal(22,0)) * cast(n as decimal(16,0))"
    score = F.expr(f"({product}) div (cast(l as {big}) * cast(r as {big}))")
    least = met.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def inside_longer(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, within``: the largest count of a phrase of one word more around a phrase. If a phrase still
    longer is as frequent as the phrase, so is one of these."""
    words = F.split("phrase", " ")
    parts = F.array(F.slice(words, F.lit(1), F.col("words") - 1), F.slice(words, F.lit(2), F.col("words") - 1))
    held = frequent.where("words > 2").select("lang", F.explode(F.transform(parts, lambda x: F.array_join(x, " "))).alias("phrase"), "a")
    return held.groupBy("lang", "phrase").agg(F.max("a").alias("within"))


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    docs = by_language(docs, lang, text)
    totals = stored(word_totals(docs), "word-totals")
    frequent = stored(frequent_phrases(docs, totals, support, longest), "frequent")
    kept = scored(frequent, totals).join(inside_longer(frequent), ["lang", "phrase"], "left").where("within is null or 100 * within < 100 * a")
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
