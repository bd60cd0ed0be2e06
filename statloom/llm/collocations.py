"""Phrase collocations: frequent word sequences whose parts stand together more often than by chance.

A phrase can be frequent only if all its parts are. Four passes over the texts use that:

1. words are counted, per language and exactly;
2. every window of 2 to 5 frequent words falls into a bucket by a hash, and the buckets are counted: a
   phrase is no more frequent than its bucket;
3. windows whose words, and whose own and whose parts' buckets, are frequent are candidates;
4. candidates are counted. They form double-array tries over (language, word, word, ...). A trie is
   broadcast; numpy takes the states of all text positions one level further at a time, a bincount
   counts the accepting ones, and the counts of all tasks are summed. A trie holds about ``MOST``
   phrases; more of them are dealt to several tries, one pass each. A pass has a task per core of the
   cluster, so that what is summed grows with the phrases and not with the splits as well.

Filters that tasks hold have fixed sizes, whatever the corpus; with more frequent phrases they let more
candidates through, never fewer. All counts that a result states come from passes 1 and 4.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.common import col, give_back, settle, share_package, slices
from statloom.llm.doublearray import build
from statloom.llm.tokens import Words, byte_set, words

LONGEST = 5  # words of a phrase
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
WORD_BITS = 1 << 23  # of the filter of frequent words
MOST_BUCKETS = 1 << 28  # of a length: 32 MB of bits
SEGMENT = 1 << 16  # buckets that are summed together
HELD = 1 << 22  # windows whose buckets a task holds before it hands their sums on
MOST = 1 << 18  # phrases of a trie, by expectation
REMEMBERED = 1 << 20  # phrases that a task doesn't name again
SALTS = 64
# exact: the products have up to 36 digits
SCORE = "(1000 * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(16, 0)) * cast(r as decimal(16, 0)))"
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _read(texts: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    """The words of a batch, and for every word whether the next one stands in the same piece."""
    w = words(texts.column("text"), BREAKS + BLANKS, lower=True)
    cuts = np.cumsum(byte_set(BREAKS)[w.data], dtype=np.int32)
    beside = np.zeros(len(w.number), dtype=bool)
    beside[:-1] = (w.doc[1:] == w.doc[:-1]) & (cuts[w.start[1:]] == cuts[w.stop[:-1] - 1])
    return w, beside


def _by_language(w: Words, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Words told apart by language: a number per word, and every number's word, language, and the languages."""
    coded = batch.column("lang").dictionary_encode()
    language = coded.indices.to_numpy()[w.doc] if len(w.doc) else np.empty(0, dtype=np.int64)
    keys, number = np.unique(language.astype(np.int64) * max(1, len(w.names)) + w.number, return_inverse=True)
    return number, keys % max(1, len(w.names)), keys // max(1, len(w.names)), coded.dictionary.cast(pa.binary()).to_pylist()


def _hashes(w: Words, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Every word's number by language, and its hash: that of Spark's ``xxhash64(lang, word)``."""
    number, name, language, languages = _by_language(w, batch)
    seeds = [xxhash.xxh64_intdigest(x, 42) for x in languages]
    names = w.names.to_pylist()
    own = [xxhash.xxh64_intdigest(names[k], seeds[j]) for k, j in zip(name.tolist(), language.tolist())]
    return number, np.array(own, dtype=np.uint64)[number]


def _held(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _linked(hashes: np.ndarray, beside: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Whether a word and the next one are frequent and stand in one piece."""
    often = _held(frequent, (hashes & np.uint64(WORD_BITS - 1)).astype(np.int64))
    link = beside & often
    link[:-1] &= often[1:]
    return link


def _windows(hashes: np.ndarray, link: np.ndarray, buckets: int, bits: dict[int, np.ndarray] | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(k, places, buckets)`` of the windows of k linked words; with ``bits`` of those that pass them."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    value, place = hashes, np.arange(len(hashes))
    passed = np.zeros(len(hashes) + 1, dtype=bool)
    for k in range(2, LONGEST + 1):
        held = link[place] if k == 2 else (place + k - 2 < len(link)) & link[np.minimum(place + k - 2, len(link) - 1)]
        place, value = place[held], value[held]
        value = value * _FACTOR + hashes[place + k - 1]
        bucket = ((value ^ (value >> np.uint64(31))) * _MIX >> shift).astype(np.int64)
        if bits is not None:
            good = _held(bits[k], bucket)
            if k > 2:
                good &= passed[place] & passed[place + 1]  # its two longest parts
            place, value, bucket = place[good], value[good], bucket[good]
            passed = np.zeros(len(hashes) + 1, dtype=bool)
            passed[place] = True
        yield k, place, bucket


def _rows(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")
    return df.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), text)


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, word, f)`` of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, _ = _read(part)
                number, name, language, languages = _by_language(w, part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(languages, pa.binary()).cast(pa.string()).take(pa.array(language)),
                        w.names.cast(pa.large_string()).take(pa.array(name)).cast(pa.string()),
                        pa.array(np.bincount(number, minlength=len(name))),
                    ],
                    names=["lang", "word", "f"],
                )
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def word_filter(frequent: DataFrame) -> np.ndarray:
    """``WORD_BITS`` bits: those that the hashes of the words set."""
    place = F.expr(f"xxhash64(lang, word) & {WORD_BITS - 1}")
    longs = frequent.select(place.alias("p")).groupBy(F.expr("p div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))
    got = longs.toArrow()  # WORD_BITS / 64 rows at most
    whole = np.zeros(WORD_BITS // 64, dtype="<i8")
    whole[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return whole.view(np.uint8)


def bucket_filters(rows: DataFrame, frequent, buckets: int, least: int) -> dict[int, np.ndarray]:
    """Per length the bits of the buckets that hold at least ``least`` windows."""
    wide = np.dtype("<u1" if least < 256 else "<u4")
    segment = min(SEGMENT, buckets)

    def summed(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for k, parts in held.items():
            place, n = np.unique(np.concatenate(parts), return_counts=True)
            # sums above the limit tell no more than the limit itself
            n = np.minimum(n, least).astype(wide)
            starts = np.flatnonzero(np.diff(place // segment, prepend=-1))
            ends = np.append(starts[1:], len(place))
            low = (place % segment).astype("<u2")
            packed = [low[i:j].tobytes() + n[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist())]
            columns = [pa.array(np.full(len(starts), k)), pa.array(place[starts] // segment), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "segment", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for part in slices(batch, "text"):
                w, beside = _read(part)
                _, hashes = _hashes(w, part)
                for k, _, bucket in _windows(hashes, _linked(hashes, beside, frequent.value), buckets):
                    held.setdefault(k, []).append(bucket)
                    size += len(bucket)
                if size >= HELD:
                    yield from summed(held)
                    held, size = {}, 0
            pa.default_memory_pool().release_unused()
        yield from summed(held)

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(segment, dtype=np.int64)
        for packed in group.column("counts").to_pylist():
            n = len(packed) // (2 + wide.itemsize)
            total[np.frombuffer(packed, dtype="<u2", count=n)] += np.frombuffer(packed, dtype=wide, offset=2 * n)
        bits = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.table({"k": group.column("k")[:1], "segment": group.column("segment")[:1], "bits": [bits]})

    parts = rows.mapInArrow(count, "k long, segment long, counts binary").groupBy("k", "segment")
    got = parts.applyInArrow(add, "k long, segment long, bits binary").toArrow()  # LONGEST * MOST_BUCKETS bits at most
    found = {k: np.zeros(max(1, buckets // 8), dtype=np.uint8) for k in range(2, LONGEST + 1)}
    for k, at, bits in zip(*(got.column(c).to_pylist() for c in ("k", "segment", "bits"))):
        found[k][at * segment // 8 : at * segment // 8 + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return found


def candidates(rows: DataFrame, frequent, bits, buckets: int) -> DataFrame:
    """``(lang, phrase, size)``: distinct windows that pass the filters of their words, parts and their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[str, str]] = set()  # phrases that this task has named already
        for batch in batches:
            for part in slices(batch, "text"):
                w, beside = _read(part)
                number, hashes = _hashes(w, part)
                names, languages = w.names.cast(pa.large_string()), part.column("lang")
                rank = number  # of the window of k - 1 words that begins at a place
                for k, place, _ in _windows(hashes, _linked(hashes, beside, frequent.value), buckets, bits.value):
                    if not len(place):
                        break
                    key = rank[place] * (int(number.max()) + 1) + number[place + k - 1]
                    _, first, again = np.unique(key, return_index=True, return_inverse=True)
                    rank = np.zeros(len(number), dtype=np.int64)
                    rank[place] = again
                    at = place[first]
                    phrase = pc.binary_join_element_wise(*[names.take(pa.array(w.number[at + j])) for j in range(k)], pa.scalar(" ", pa.large_string()))
                    named = zip(languages.take(pa.array(w.doc[at])).to_pylist(), phrase.to_pylist())
                    fresh = [x for x in named if x not in sent]
                    if len(sent) + len(fresh) > REMEMBERED:
                        sent.clear()
                    sent.update(fresh)
                    if fresh:
                        columns = [pa.array(c, pa.string()) for c in zip(*fresh)]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(fresh), k))], names=["lang", "phrase", "size"])
            pa.default_memory_pool().release_unused()

    found = _by_core(rows).mapInArrow(run, "lang string, phrase string, size long")
    return found.distinct()


def _by_core(rows: DataFrame) -> DataFrame:
    """Rows in as many tasks as there are cores: each of them names or counts all phrases once, however many splits it reads."""
    return rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def _digits(numbers: int) -> list[int]:
    """The shifts of the bytes of numbers below ``numbers``, the highest first."""
    return list(range(8 * ((max(1, numbers - 1).bit_length() + 7) // 8 - 1), -1, -8))


def trie_counts(rows: DataFrame, phrases: pa.Table) -> tuple[DataFrame, Broadcast]:
    """``(lang, phrase, size, f)``: exact counts of the given phrases, those found at all; and the broadcast trie."""
    languages = phrases.column("lang").combine_chunks().dictionary_encode()
    split = pc.split_pattern(phrases.column("phrase").combine_chunks(), " ")
    flat = split.flatten()
    counted = flat.value_counts()  # frequent words get small numbers: their digits are shared by many
    vocabulary = counted.field("values").take(pc.sort_indices(counted.field("counts"), sort_keys=[("", "descending")]))
    word_numbers = pc.index_in(flat, value_set=vocabulary).to_numpy()
    sizes = pc.list_value_length(split).to_numpy()
    numbers = np.full((len(split), LONGEST + 1), -1, dtype=np.int64)
    numbers[:, 0] = languages.indices.to_numpy() + len(vocabulary)
    row = np.repeat(np.arange(len(sizes)), sizes)
    numbers[row, 1 + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = word_numbers
    # a language or word is its number's digits, so that a state has few symbols and the array few gaps
    digits = _digits(len(vocabulary) + len(languages.dictionary))
    paths = np.stack([np.where(numbers < 0, -1, numbers >> shift & 0xFF) for shift in digits], axis=2).reshape(len(split), (LONGEST + 1) * len(digits))
    listed = phrases.select(["lang", "phrase", "size"]).combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast((build(paths), vocabulary, languages.dictionary, listed))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, vocabulary, known, listed = shared.value
        digits = _digits(len(vocabulary) + len(known))

        def further(state: np.ndarray, number: np.ndarray) -> np.ndarray:
            for shift in digits:
                state = np.where(state >= 0, trie.step(np.maximum(state, 0), np.where(number < 0, -1, number >> shift & 0xFF)), -1)
            return state

        total = np.zeros(len(listed), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                w, beside = _read(part)
                if not len(w.number):
                    continue
                symbols = pc.fill_null(pc.index_in(w.names.cast(pa.large_string()).cast(vocabulary.type), value_set=vocabulary), -1).to_numpy()[w.number].astype(np.int64)
                own = pc.fill_null(pc.index_in(part.column("lang").cast(known.type), value_set=known), -1).to_numpy().astype(np.int64)
                own[own >= 0] += len(vocabulary)
                place = np.arange(len(symbols))
                state = further(np.zeros(len(symbols), dtype=np.int64), own[w.doc])
                for k in range(LONGEST):
                    alive = state >= 0
                    if k:  # the next word has to stand in the same piece
                        alive &= place + k < len(symbols)
                        alive &= beside[np.minimum(place + k - 1, len(symbols) - 1)]
                    place = place[alive]
                    state = further(state[alive], symbols[place + k])
                    ended = trie.accept[state[state >= 0]]
                    total += np.bincount(ended[ended >= 0], minlength=len(total))
            pa.default_memory_pool().release_unused()
        held = np.flatnonzero(total)
        for at in range(0, len(held), 1 << 16):
            some = held[at : at + (1 << 16)]
            found = listed.take(pa.array(some)).combine_chunks().append_column("f", pa.array(total[some]))
            yield from found.to_batches()

    counts = _by_core(rows).mapInArrow(count, "lang string, phrase string, size long, f long")
    return counts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")), shared


def frequent_phrases(rows: DataFrame, single: DataFrame, n_words: int, least: int, most: int = MOST) -> DataFrame:
    """``(lang, phrase, size, f)`` of all phrases of 2 to ``LONGEST`` words that occur ``least`` times or more."""
    spark = rows.sparkSession
    share_package(spark)
    buckets = 1 << min(MOST_BUCKETS.bit_length() - 1, max(16, (n_words // 8).bit_length()))
    frequent = spark.sparkContext.broadcast(word_filter(single))
    bits = spark.sparkContext.broadcast(bucket_filters(rows, frequent, buckets, least))
    found = settle(candidates(rows, frequent, bits, buckets), "candidates")
    tries = max(1, -(-found.count() // most))
    counted = []
    for trie in range(tries):
        own = found.where(F.expr(f"pmod(xxhash64(lang, phrase), {tries}) = {trie}")) if tries > 1 else found
        counts, shared = trie_counts(rows, own.toArrow())
        counted.append(settle(counts.where(F.col("f") >= least), "counted"))
        shared.destroy()  # the counts are written
        give_back()
    return reduce(DataFrame.unionByName, counted)


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, top: int = 2000, most: int = MOST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` collocations.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, and these at blanks and
    tabs into words. A phrase of 2 to 5 words that occurs ``a >= least`` times is cut where
    ``floor(1000 * a * n / (l * r))`` is least (ties: first cut), ``l`` and ``r`` being the counts of the two
    parts and ``n`` that of all words; a phrase inside a longer one that occurs as often is left out. The order
    is by score, then count, both descending, then by the phrase's bytes.

    A NULL language is ``und``; NULL and empty texts hold no words; repeated rows count each; an empty
    table gives no rows; other columns don't matter.
    """
    rows = _rows(df, lang_col, text_col)
    share_package(df.sparkSession)
    single = settle(word_counts(rows), "words")
    totals = single.groupBy("lang").agg(F.sum("f").alias("n"))
    n_words = single.agg(F.sum("f")).first()[0] or 0
    often = single.where(F.col("f") >= least)
    phrases = frequent_phrases(rows, often, n_words, least, most)
    parts = often.select("lang", F.col("word").alias("part"), "f").unionByName(phrases.select("lang", F.col("phrase").alias("part"), "f"))

    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, cast(size as int) - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    score = F.expr(SCORE)
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    longer = phrases.where("size > 2").select("lang", "f", F.explode(F.expr("array(substring_index(phrase, ' ', cast(size as int) - 1), substring(phrase, instr(phrase, ' ') + 1))")).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
