r"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces at punctuation and line ends, pieces into words.  The graph's edges are
the longest grams (five words, from the node of their first four to that of their last four).
Each place in a piece gives one record: the edge that starts there or, in the last four places,
the shorter gram up to the piece's end, which is the correction for that end.  Records are
added up in the tasks and then over all of them.

A node's count is its flow: the edges that leave it plus the pieces that end in it.  Applied
again that gives all counts of four words from those of five, of three from four, down to the
node without words, which is the number of words of the language.

Only what occurs ``least`` times can be a phrase or a part of one.  So a place's gram may stop before a
pair of neighbours that is rarer, as if the piece ended there: that changes no count that matters.
Which pairs are rarer is read from ``2 ** BITS`` hashed counts, one bit each: a table of fixed size (32 MB) at any scale, and
wrong only by calling a rare pair frequent, which costs a longer record and changes no count.

Paths: a node all of whose flow comes from or goes to one edge lies inside a unary path; path and
edge have one count.  Such nodes are compacted into their edge, and what is left - edges and branching
nodes - are the candidates.  As counts fall with length, that drops just the phrases that a longer
candidate contains as often.

Scores are whole numbers from decimal products of up to 38 digits.

Rows: a null or empty text has no words; a null language is ``und``; repeated rows count each; other
columns are not read; an empty table gives an empty result.  Very long texts are read in
slices, cut between words, so that memory is bounded by the slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, table

LONGEST, LEAST, FIRST = 5, 100, 2000
#: Size of the table of hashed counts of pairs, as a power of two.
BITS = 28
#: Places in a piece that a task adds up at once, words it remembers, and bytes of a text it reads at once.
PLACES, WORDS, SLICE = 1 << 19, 300_000, 1 << 21
#: A byte that UTF-8 never has stands for the cut between pieces.
CUT = b"\xff"
_BYTES = bytes(
    0xFF if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 0x09 else c + 32 if 65 <= c <= 90 else c
    for c in range(256)
)


def _tokens(text: str) -> Iterator[list[bytes]]:
    """Words of a text with ``CUT`` between pieces, in lists of bounded size."""
    raw = text.encode("utf-8", "surrogatepass").translate(_BYTES)
    at = 0
    while at < len(raw):
        end = at + SLICE
        if end < len(raw):  # back to a border; forward if a word is longer than a slice
            end = max(raw.rfind(b" ", at, end), raw.rfind(CUT, at, end)) + 1
            if end <= at:
                ends = [x for x in (raw.find(b" ", at), raw.find(CUT, at)) if x >= 0]
                end = min(ends) + 1 if ends else len(raw)
        yield raw[at:end].replace(CUT, b" \xff ").split(b" ")
        at = end


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if text := text.as_py():
                yield lang, text


#: Codes that are no words: a cut between pieces, and the empty string between two spaces.
END, SKIP = 0, 1


class _Words(dict):
    """Word of one language -> its number in a task's lists."""

    def __init__(self, lang: str, lists: _Lists):
        super().__init__({CUT: END, b"": SKIP})
        self.lang, self.lists, self.seed = lang, lists, xxhash.xxh3_64_intdigest(lang)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.lists.names)
        self.lists.names.append(word)
        self.lists.langs.append(self.lang)
        self.lists.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        return code


class _Lists:
    """The words of a task: name, language and hash by number."""

    def __init__(self) -> None:
        self.names, self.langs, self.hashes = [CUT, b""], ["", ""], [0, 0]
        self.words: dict[str, _Words] = {}

    def of(self, lang: str) -> _Words:
        if lang not in self.words:
            self.words[lang] = _Words(lang, self)
        return self.words[lang]

    def codes(self, lang: str, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.of(lang).__getitem__, words), np.int64, len(words))
        return found[found != SKIP]

    def buckets(self, codes: np.ndarray, bits: int) -> np.ndarray:
        """Where each code and the one after it are counted as a pair."""
        hashes = np.array(self.hashes, np.uint64)[codes]
        pairs = (hashes[:-1] ^ (hashes[:-1] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        pairs = (pairs ^ (pairs >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return (pairs >> np.uint64(64 - bits)).astype(np.int64)


def frequent(docs: DataFrame, least: int = LEAST, bits: int = BITS) -> bytes:
    """Bit b: whether the pairs of neighbours counted in bucket b occur ``least`` times together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, parts, waiting = _Lists(), [], 0

        def pairs() -> pa.RecordBatch:
            codes = np.concatenate([*parts, [END]]).astype(np.int64)
            both = (codes[:-1] != END) & (codes[1:] != END)
            return pa.RecordBatch.from_pydict({"bucket": pa.array(lists.buckets(codes, bits)[both])})

        for lang, text in _texts(batches):
            for words in _tokens(text):
                parts.append(lists.codes(lang, words))
                waiting += len(parts[-1])
                if waiting >= PLACES:
                    yield pairs()
                    parts, waiting = [parts[-1][-1:]], 1  # the last word may have a neighbour yet
                    if len(lists.names) > WORDS:
                        last = lists.names[parts[0][0]] if len(parts[0]) else CUT
                        lists = _Lists()
                        parts = [lists.codes(lang, [last])]
            parts.append(np.array([END]))
        yield pairs()

    sums = docs.mapInArrow(run, "bucket long").groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    # 32,768 bits a row: 2 ** bits / 8 bytes in all, whatever the data; these functions number bits from 1
    bit = sums.select((F.col("bucket") + 1).alias("bit"))
    maps = bit.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = bytearray(max(1 << bits >> 3, 4096))
    for part, found in maps.collect():
        out[(part - 1) * 4096 : part * 4096] = found
    return bytes(out)


class _Places:
    """The places of one task; gives their records, added up over ``PLACES`` at a time."""

    def __init__(self, hot: bytes, bits: int):
        self.hot, self.bits, self.lists = np.frombuffer(hot, np.uint8), bits, _Lists()
        self.parts: list[np.ndarray] = []
        self.waiting = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        self.parts.append(self.lists.codes(lang, words))
        self.waiting += len(self.parts[-1])

    def end(self) -> None:
        self.parts.append(np.array([END]))
        self.waiting += 1

    def _record(self, columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        names = pa.array(self.lists.names, pa.binary())
        words = [names.take(pa.array(c, mask=c == END)).cast(pa.string()) for c in columns]
        gram = pc.binary_join_element_wise(*words, " ", null_handling="skip") if len(words) > 1 else words[0]
        lang = pa.array(self.lists.langs, pa.string()).take(pa.array(columns[0]))
        size = sum((c != END).astype(np.int32) for c in columns)
        return pa.RecordBatch.from_arrays([lang, gram, pa.array(size, pa.int32()), pa.array(n, pa.int64())], ["lang", "gram", "size", "n"])

    def records(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """Records of all places whose longest gram is known; with ``last``, of all."""
        codes = np.concatenate([*self.parts, np.full(LONGEST - 1 if last else 0, END)]) if self.parts else np.zeros(0, np.int64)
        places = len(codes) - (LONGEST - 1)
        if places > 0:
            bucket = self.lists.buckets(codes, self.bits)
            joined = (codes[:-1] != END) & (codes[1:] != END) & ((self.hot[bucket >> 3] >> (bucket & 7) & 1) != 0)
            at = np.flatnonzero(codes[:places] != END)
            alone = ~joined[at]
            n = np.bincount(codes[at[alone]], minlength=1)
            yield self._record([np.flatnonzero(n)], n[n > 0])
            at = at[~alone]
            columns, inside = [codes[at]], np.full(len(at), True)
            for j in range(1, LONGEST):
                inside = inside & joined[at + j - 1]
                columns.append(np.where(inside, codes[at + j], END))
            base = len(self.lists.names)
            if base >= 1 << 21:
                raise OverflowError("too many different words at once")
            head, tail = (columns[0] * base + columns[1]) * base + columns[2], columns[3] * base + columns[4]
            order = np.lexsort((tail, head))
            head, tail = head[order], tail[order]
            starts = np.flatnonzero(np.append(True, (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]))) if len(order) else order
            yield self._record([c[order[starts]] for c in columns], np.diff(np.append(starts, len(order))))
            codes = codes[places:]
        if len(self.lists.names) > WORDS:  # forget the words, but for those of the places kept
            kept = [(self.lists.langs[c], self.lists.names[c]) for c in codes.tolist()]
            self.lists = _Lists()
            codes = np.array([END if word == CUT else self.lists.of(lang)[word] for lang, word in kept], np.int64)
        self.parts, self.waiting = [codes], len(codes)


def edges(docs: DataFrame, hot: bytes, bits: int = BITS) -> DataFrame:
    """Records of all places, added up: ``lang, gram, size, n``, stored by size."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(shared.value, bits)
        for lang, text in _texts(batches):
            for words in _tokens(text):
                places.add(lang, words)
                if places.waiting >= PLACES:
                    yield from places.records()
            places.end()
        yield from places.records(last=True)

    found = docs.mapInArrow(run, "lang string, gram string, size int, n long")
    return stash(found.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n")), "edges", by="size")


def counts(edges: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, gram, size, n`` of every gram that occurs ``least`` times, and ``lang, total`` words of each language."""
    level = edges.where(F.col("size") == LONGEST).select("lang", "gram", "n")
    heavy = level.withColumn("size", F.lit(LONGEST))
    for size in range(LONGEST - 1, -1, -1):
        flow = level.select("lang", F.substring_index("gram", " ", size).alias("gram"), "n")
        ends = edges.where(F.col("size") == size).select("lang", "gram", "n")
        level = stash(flow.union(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n")), f"flow-{size}")
        if size:
            heavy = heavy.union(level.withColumn("size", F.lit(size)))
    return heavy.where(F.col("n") >= least), level.select("lang", F.col("n").alias("total"))


def compacted(heavy: DataFrame) -> DataFrame:
    """Edges and branching nodes of two words and more: no node with all its flow along one edge."""
    both = [
        heavy.where("size > 2").select("lang", F.expr(f"substring_index(gram, ' ', {way} * (size - 1))").alias("gram"), F.col("n").alias("along"))
        for way in (1, -1)
    ]
    along = both[0].union(both[1]).groupBy("lang", "gram").agg(F.max("along").alias("along"))
    nodes = heavy.where("size > 1").join(along, ["lang", "gram"], "left")
    return nodes.where("along is null or along < n").select("lang", "gram", "size", F.col("n").alias("a"))


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, bits: int = BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` phrases of each language by the score of their weakest cut."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("string"))
    found, words = counts(edges(docs, frequent(docs, least, bits), bits), least)
    heavy = stash(found, "heavy")
    cut = compacted(heavy).select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("at"))
    part = heavy.select("lang", F.col("gram"), F.col("n"))
    left = part.toDF("lang", "left", "l")
    right = part.toDF("lang", "right", "r")
    cut = cut.withColumns({"left": F.expr("substring_index(gram, ' ', at)"), "right": F.expr("substring_index(gram, ' ', at - size)")})
    cut = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(words, "lang")
    whole = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "total")}
    score = F.call_function("div", 1000 * whole["a"] * whole["total"], whole["l"] * whole["r"])
    weakest = cut.groupBy("lang", "gram", "a", "total").agg(F.min(F.struct(score.alias("score"), "at", "l", "r")).alias("cut"))
    rows = weakest.select("lang", F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    place = F.row_number().over(_best_first())
    ranked = rows.withColumn("rank", place).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _best_first():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")


def op13(spark, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of all ``documents``."""
    return collocations(table(spark, sf_dir, "documents", spread=True))


OP13_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text is not null),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
grams as (select lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) as k from places),
counted as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f from grams group by all),
total as (select lang, sum(f)::bigint as n from counted where k = 1 group by lang),
heavy as (select lang, k, phrase, string_split(phrase, ' ') as w, f from counted where f >= 100),
inner_phrases as (
    select distinct h.lang, array_to_string(h.w[i:i + m - 1], ' ') as phrase, h.f
    from heavy h, (select unnest(range(2, 5)) as m), (select unnest(range(1, 5)) as i) where m < h.k and i + m - 1 <= h.k),
candidates as (
    select c.lang, c.k, c.phrase, c.w, c.f as a from heavy c
    left join (select lang, phrase, max(f) as f from inner_phrases group by all) o on o.lang = c.lang and o.phrase = c.phrase
    where c.k > 1 and (o.f is null or 100 * o.f < 100 * c.f)),
cuts as (
    select c.lang, c.phrase, c.a, i, array_to_string(c.w[1:i], ' ') as head, array_to_string(c.w[i + 1:], ' ') as tail
    from candidates c, (select unnest(range(1, 5)) as i) where i < c.k),
scored as (
    select c.lang, c.phrase, c.a, x.f as l, y.f as r, t.n, i, ((1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f))::bigint as score
    from cuts c join heavy x on x.lang = c.lang and x.phrase = c.head
    join heavy y on y.lang = c.lang and y.phrase = c.tail join total t on t.lang = c.lang),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, i) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from weakest qualify rank <= 2000
"""
