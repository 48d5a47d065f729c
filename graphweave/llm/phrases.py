"""Collocations by Toivonen's method: phrases that stand together more often than their parts.

Texts (A-Z lower-cased) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``; phrases are runs of words of a piece. Everything is counted per language (null:
``und``). A phrase of 2 to ``LONGEST`` words with ``a >= least`` occurrences is a candidate; cut in
two, it scores ``floor(1000 * a * n / (l * r))`` with the counts ``l`` and ``r`` of its parts among
``n`` words, and its lowest-scoring cut counts. A candidate that stands in a longer one just as
frequent is dropped; each language's first ``top`` are returned.

Method. A share ``SAMPLE`` of the documents proposes phrases: those frequent in it at a lowered
bound. One pass over all documents then counts, exactly, the proposed phrases and their *negative
border*: phrases that were not proposed but whose first and last ``k - 1`` words both were (every
single word belongs to one or the other). Where a border phrase turns out frequent, longer
phrases over it have not been counted: it joins the proposals and a further pass counts what
they add, until no border phrase fails. Then every frequent phrase has been counted, whatever the
sample held: were one missing, a shortest missing one would have had both its parts among
the proposals. The sample decides the number of passes, never the result.

Distribution. Proposals are looked up in a bit table of fixed size (``TABLE_BITS``, 8 MB, broadcast),
which may hold too much but never too little: phrases counted needlessly cost time and change
nothing, so no set that grows with the corpus is sent to the tasks. Tasks count their phrases
before anything travels, as 64-bit keys (61 bits of hash, 3 of length) packed per bucket; a word that
stands everywhere costs one entry per task. Buckets add up and leave only frequent phrases, written to
the shared folder. Their texts and the keys of their parts are read off one occurrence, in the
sample first and for phrases that it lacks in one more pass. Scores are exact decimals of 38 digits.

Defined results: null and empty texts hold no words; repeated rows count each; a language without
candidates has no rows; an empty table gives none. Ids play no part and other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .line_crf import stretches
from .textblocks import Words, mix, pack, rows, split_by, unpack, utf8
from .written import written

LONGEST = 5
SAMPLE = 10  # one document in so many proposes
TABLE_BITS = 26
BUCKET_BYTES = 8 << 20  # text whose phrases one bucket adds up
_HOLD = 1 << 20  # distinct phrases a task counts before it sends them
_A = np.uint64(0x9E3779B97F4A7C15)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _SEPARATOR.copy()
_BETWEEN[[0x20, 0x09]] = True


# ---------------------------------------------------------------- phrases of a batch


class Phrases:
    """The words of some texts and the keys of all their phrases."""

    def __init__(self, text: pa.Array, salt: np.ndarray):
        self.buf, offsets = utf8(text)
        self.words = w = Words(self.buf, offsets, lower=True, space=_BETWEEN)
        self.doc = w.doc_of()
        cut = np.concatenate([[0], np.cumsum(_SEPARATOR[self.buf], dtype=np.int64)])
        self.piece = cut[w.start] + self.doc  # rises with every separator and every document
        self.salt = mix(salt)[self.doc]
        self.keys: list[np.ndarray] = [None]
        h = w.hash
        for k in range(1, LONGEST + 1):
            if k > 1:
                h = mix(h[: max(0, len(w.hash) - k + 1)] * _A + w.hash[k - 1 :])
            self.keys.append((mix(h + self.salt[: len(h)]) << np.uint64(3)) | np.uint64(k))

    def whole(self, k: int) -> np.ndarray:
        """Which runs of ``k`` words lie in one piece."""
        n = len(self.keys[k])
        return self.piece[:n] == self.piece[k - 1 : k - 1 + n]


def language_key(salt: np.ndarray) -> np.ndarray:
    return mix(mix(salt)) << np.uint64(3)


def _place(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _place(keys)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) == 1


class Counter:
    """Counts of keys, sent as one packed value per bucket."""

    def __init__(self, n_buckets: int):
        self.n_buckets, self.parts, self.size = n_buckets, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None):
        if len(keys):
            self.parts.append(summed(keys, np.ones(len(keys), np.int64) if counts is None else counts))
            self.size += len(self.parts[-1][0])

    def full(self) -> bool:
        if self.size > 2 * _HOLD:
            self._merge()
        return self.size > _HOLD

    def _merge(self):
        if len(self.parts) > 1:
            self.parts = [summed(*(np.concatenate(x) for x in zip(*self.parts)))]
        self.size = len(self.parts[0][0]) if self.parts else 0

    def send(self) -> pa.RecordBatch:
        self._merge()
        out = []
        if self.parts:
            k, c = self.parts[0]
            bucket = ((k >> np.uint64(3)) % np.uint64(self.n_buckets)).astype(np.int64)
            small = c.astype(np.int32) if c.max() < 1 << 31 else c
            out = [(b, pack(x, y)) for b, (x, y) in split_by(bucket, k, small)]
        self.parts, self.size = [], 0
        t = rows(out, pa.schema([("bucket", pa.int32()), ("payload", pa.binary())]))
        return t.combine_chunks().to_batches()[0] if out else pa.RecordBatch.from_arrays([pa.array([], f.type) for f in t.schema], schema=t.schema)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(counts[order].astype(np.int64), first)


def _texts(batches):
    for batch in batches:
        salt = batch.column(0).to_numpy().view(np.uint64)
        for lo, hi in stretches(batch.column(1)):
            yield batch, lo, hi, Phrases(batch.column(1).slice(lo, hi - lo), salt[lo:hi])


def _count_all(n_buckets: int):
    """All phrases of the sample."""

    def run(batches):
        held = Counter(n_buckets)
        for _, _, _, p in _texts(batches):
            for k in range(1, LONGEST + 1):
                held.add(p.keys[k][p.whole(k)])
                if held.full():
                    yield held.send()
        yield held.send()

    return run


def _count_proposed(old, new, n_buckets: int):
    """Proposals and their negative border. With ``new`` only what it adds to ``old``: phrases
    whose parts are proposed now and were not before."""

    def run(batches):
        held = Counter(n_buckets)
        was = old.value
        now = was if new is None else new.value
        for batch, lo, hi, p in _texts(batches):
            if new is None:
                held.add(p.keys[1])
                salt = batch.column(0).to_numpy().view(np.uint64)[lo:hi]
                some = p.words.n_words > 0
                held.add(language_key(salt[some]), p.words.n_words[some].astype(np.int64))
            proposed = in_table(now, p.keys[1])
            before = proposed if new is None else in_table(was, p.keys[1])
            for k in range(2, LONGEST + 1):
                n = len(p.keys[k])
                at = np.flatnonzero(proposed[:n] & proposed[1 : n + 1] & p.whole(k))
                held.add(p.keys[k][at if new is None else at[~(before[at] & before[at + 1])]])
                keys = p.keys[k][at]
                proposed, before_k = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
                proposed[at] = in_table(now, keys)
                if new is not None:
                    before_k[at] = in_table(was, keys) & before[at] & before[at + 1]
                before = before_k
                if held.full():
                    yield held.send()
        yield held.send()

    return run


def _add_up(least: int):
    schema = pa.schema([("key", pa.int64()), ("count", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        got = [unpack(x.as_py()) for x in table.column("payload")]
        k, c = summed(np.concatenate([x for x, _ in got]), np.concatenate([y for _, y in got]))
        often = c >= least
        return pa.table([pa.array(k[often].view(np.int64)), pa.array(c[often])], schema=schema)

    return run


# ---------------------------------------------------------------- passes


def _counted(texts: DataFrame, count, n_buckets: int, least: int) -> DataFrame:
    sent = texts.select("salt", "text").mapInArrow(count(n_buckets), "bucket int, payload binary")
    sums = sent.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(_add_up(least), "key long, count long")
    return written(sums, "phrase-counts")


def _bits(keys: DataFrame) -> np.ndarray:
    """The bit table of a table of keys; its size does not depend on theirs."""
    place = F.shiftrightunsigned("key", 64 - TABLE_BITS)
    byte = keys.groupBy(F.shiftrightunsigned(place, 3).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1, cast(shiftrightunsigned(key, {64 - TABLE_BITS}) & 7 as int))")).alias("bits"))
    got = byte.toArrow()
    table = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
    table[got.column("at").to_numpy()] = got.column("bits").to_numpy().astype(np.uint8)
    return table


def _outside(keys: DataFrame, table) -> DataFrame:
    """The keys that a bit table lacks."""

    def run(batches):
        for batch in batches:
            k = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(k[~in_table(table.value, k.view(np.uint64))])], names=["key"])

    return keys.select("key").mapInArrow(run, "key long")


def frequent(spark: SparkSession, texts: DataFrame, sample: DataFrame, least: int, n_bytes: int) -> DataFrame:
    """``(key, count)`` of every phrase of up to ``LONGEST`` words that occurs ``least`` times, and
    of every language with as many words (length 0)."""
    n_buckets = max(1, -(-n_bytes // BUCKET_BYTES))
    low = max(2, least // SAMPLE // 2)
    proposals = _counted(sample, _count_all, max(1, n_buckets // 2), low)
    table = _bits(proposals.select("key"))
    old, new, found = spark.sparkContext.broadcast(table), None, []
    while True:
        now = new or old
        found.append(_counted(texts, lambda n, o=old, w=new: _count_proposed(o, w, n), n_buckets, least))
        # phrases of the greatest length have no border; lengths 1 and up do
        longer = (F.col("key").bitwiseAND(7) > 0) & (F.col("key").bitwiseAND(7) < LONGEST)
        failed = written(_outside(found[-1].filter(longer), now), "failed-border")
        if failed.isEmpty():
            break
        old = now
        new = spark.sparkContext.broadcast(now.value | _bits(failed))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


_SPELLED = "key long, lang string, phrase string, size int, first array<long>, rest array<long>, language long"


def _spell(table):
    """Of each phrase of a bit table that a task meets: its words and the keys of all its cuts."""
    schema = pa.schema([
        ("key", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()),
        ("first", pa.list_(pa.int64())), ("rest", pa.list_(pa.int64())), ("language", pa.int64()),
    ])

    def run(batches):
        told: set[int] = set()
        for batch, lo, hi, p in _texts(batches):
            lang = batch.column(2)
            salt = batch.column(0).to_numpy().view(np.uint64)
            signed = [None, *(k.view(np.int64) for k in p.keys[1:])]
            start, end = p.words.start, p.words.end
            out = []
            for k in range(2, LONGEST + 1):
                at = np.flatnonzero(p.whole(k))
                at = at[in_table(table.value, p.keys[k][at])]
                _, one = np.unique(p.keys[k][at], return_index=True)
                for i in at[one].tolist():
                    key = int(signed[k][i])
                    if key in told:
                        continue
                    told.add(key)
                    words = [p.buf[start[j] : end[j]].tobytes() for j in range(i, i + k)]
                    doc = lo + int(p.doc[i])
                    out.append((key, lang[doc].as_py(), b" ".join(words).lower().decode("utf-8"), k,
                                [int(signed[j][i]) for j in range(1, k)], [int(signed[k - j][i + j]) for j in range(1, k)],
                                int(language_key(salt[doc : doc + 1]).view(np.int64)[0])))
            if len(told) > _HOLD:
                told.clear()
            yield from rows(out, schema).to_batches()

    return run


def _spelled(spark: SparkSession, wanted: DataFrame, texts: DataFrame, sample: DataFrame) -> DataFrame:
    """The frequent phrases of two words and more with their texts and parts."""

    def read(source: DataFrame, missing: DataFrame) -> DataFrame:
        table = spark.sparkContext.broadcast(_bits(missing))
        got = source.select("salt", "text", "lang").mapInArrow(_spell(table), _SPELLED)
        return written(got.join(missing, "key").dropDuplicates(["key"]), "spelled")

    found = read(sample, wanted)
    missing = written(wanted.join(found, "key", "left_anti"), "unspelled")
    if not missing.isEmpty():
        found = found.unionByName(read(texts, missing))
    return found


def collocations(
    docs: DataFrame, least: int = 100, top: int = 2000, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``, each language's first ``top``."""
    spark = docs.sparkSession
    named = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    t = docs.select(named.alias("lang"), F.xxhash64(named).alias("salt"), F.col(text).cast("string").alias("text"),
                    F.xxhash64(F.col(doc_id), F.octet_length(F.col(text).cast("string"))).alias("pick"))
    sample = written(t.filter(F.pmod("pick", F.lit(SAMPLE)) == 0).drop("pick"), "phrase-sample")
    n_bytes = int(t.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    counts = frequent(spark, t, sample, least, n_bytes)

    size = F.col("key").bitwiseAND(7)
    wanted = counts.filter(size > 1).select("key")
    p = _spelled(spark, wanted, t, sample).join(counts.withColumnRenamed("count", "a"), "key")
    p = written(p, "candidates")
    # a longer phrase as frequent stands behind one that is longer by a word and as frequent
    ends = p.filter("size > 2").select(F.explode(F.array(F.element_at("first", -1), F.element_at("rest", 1))).alias("key"), "a")
    beyond = ends.groupBy("key").agg(F.max("a").alias("longer"))
    alone = p.join(beyond, "key", "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("a")))

    cuts = alone.select("key", "language", "a", F.posexplode(F.arrays_zip("first", "rest")).alias("cut", "part"))
    cuts = cuts.select("key", "language", "a", "cut", F.col("part.first").alias("first"), F.col("part.rest").alias("rest"))
    for part, name in (("first", "l"), ("rest", "r"), ("language", "n")):
        cuts = cuts.join(counts.select(F.col("key").alias(part), F.col("count").alias(name)), part)
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    cuts = cuts.withColumn("above", wide["a"] * wide["n"] * F.lit(1000)).withColumn("below", wide["l"] * wide["r"])
    cuts = cuts.withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("key").agg(F.min(F.struct("score", "cut", "l", "r", "n")).alias("best"))
    scored = alone.join(best, "key").select("lang", "phrase", "a", "best.l", "best.r", "best.n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return scored.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _sql() -> str:
    """Level by level: a frequent run of words is a frequent one and a frequent word after it."""
    steps = ["f1 as (select lang, p, 1 as k, count(*) as c from words group by all having count(*) >= 100)",
             "t1 as materialized (select words.* from words semi join f1 using (lang, p))"]
    for k in range(2, LONGEST + 1):
        steps += [
            f"a{k} as materialized (select a.lang, a.piece, a.pos, a.p || ' ' || b.p as p from t{k - 1} a "
            f"join t1 b on a.piece = b.piece and b.pos = a.pos + {k - 1})",
            f"f{k} as (select lang, p, {k} as k, count(*) as c from a{k} group by all having count(*) >= 100)",
            f"t{k} as materialized (select a{k}.* from a{k} semi join f{k} using (lang, p))",
        ]
    levels = " union all ".join(f"select * from f{k}" for k in range(1, LONGEST + 1))
    return r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
worded as (select row_number() over () as piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
words as materialized (select lang, piece, unnest(range(len(ws))) as pos, unnest(ws) as p from worded),
total as (select lang, count(*)::hugeint as n from words group by lang),
""" + ",\n".join(steps) + f""",
f as materialized ({levels}),
split as (select *, string_split(p, ' ') as ws from f where k > 1),
cuts as (
    select x.lang, x.p, x.k, x.c as a, cut, l.c as l, r.c as r, n, (1000 * x.c::hugeint * n) // (l.c::hugeint * r.c) as score
    from (select *, unnest(range(1, k)) as cut from split) x
    join f l on l.lang = x.lang and l.p = array_to_string(x.ws[1:cut], ' ')
    join f r on r.lang = x.lang and r.p = array_to_string(x.ws[cut + 1:x.k], ' ')
    join total on total.lang = x.lang
),
best as (select * from cuts qualify row_number() over (partition by lang, p order by score, cut) = 1),
ends as (
    select lang, array_to_string(ws[1:k - 1], ' ') as p, c from split where k > 2
    union all select lang, array_to_string(ws[2:k], ' '), c from split where k > 2
),
longer as (select lang, p, max(c) as c from ends group by all),
kept as (select best.* from best left join longer using (lang, p) where longer.c is null or longer.c < a)
select lang, row_number() over (partition by lang order by score desc, a desc, p)::bigint as "rank", p as phrase, a, l, r,
    n::bigint as n, score::bigint as score
from kept qualify "rank" <= 2000
"""


COLLOCATIONS_SQL = _sql()
