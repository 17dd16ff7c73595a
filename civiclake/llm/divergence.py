"""How far sources of one language differ in the words they use: exact sums over smoothed term shares.

Terms are counted in the map tasks by length-bucketed packing. The bytes of many texts are one array; each run of term bytes goes
to the bucket of its length. Terms of up to 8 bytes become one 64-bit word, those of up to 16 two, first byte highest, so that
words order like bytes. A bucket is radix-sorted by its 16-bit digits, as many as its terms have, and equal neighbours are counted
as runs; longer terms are sorted as byte strings in buckets of doubling width. Texts are laid out by group before, so a stable sort
leaves the occurrences of a term in order of group and document, and one pass over them counts both.

A task merges what its blocks of text gave, then each language's terms are dealt out once, summed, and cut to those in enough
documents. All that follows works on these: shares in integer arithmetic, and pairwise sums over blocks of whole terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.common import stored

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
RANKS = 50
#: Bytes of text counted at once (one text at least), and rows a task merges before it hands them on.
TEXT_BYTES = 4 << 20
MERGED_ROWS = 400_000
#: Rows of a block of terms whose sources are compared at once, at least and at most; cells of a dense part of it.
BLOCK_ROWS, MOST_BLOCK_ROWS = 1 << 16, 1 << 20
CELLS = 1 << 20

#: Term bytes as they are, A-Z in lower case; all others 0.
_TERM = np.arange(256, dtype=np.uint8)
_TERM[:0x80] = 0
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
#: Keeps the first k bytes of a word.
_FIRST = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], dtype=np.uint64)


def _radix_order(words: list[np.ndarray], digits: int) -> np.ndarray:
    """The stable order by the first ``digits`` 16-bit digits of the words, last digit first."""
    order = np.arange(len(words[0]))
    for k in reversed(range(digits)):
        digit = (words[k // 4] >> np.uint64(48 - 16 * (k % 4))).astype(np.uint16)
        order = order[np.argsort(digit[order], kind="stable")]  # numpy sorts 16-bit numbers by radix
    return order


def _runs(differs: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places of equal (term, group), with occurrences and documents; ``differs``: whether a term differs from the one before."""
    if not len(group):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.concatenate(([True], differs | (group[1:] != group[:-1])))
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(new))), np.add.reduceat(fresh.astype(np.int64), starts)


def _spelled(words: list[np.ndarray]) -> np.ndarray:
    """Words as byte strings; trailing zeros are no part of them."""
    return np.ascontiguousarray(np.stack(words, axis=1).astype(">u8")).view(f"S{8 * len(words)}").ravel()


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per bucket: terms, their groups, occurrences and documents; one row per term and group. ``groups``: a number per text."""
    by_group = np.argsort(groups, kind="stable")
    joined = b"\0".join([*(texts[k] for k in by_group), bytes(16)])
    term = _TERM[np.frombuffer(joined, dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(term != 0, prepend=False))
    starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
    sizes = np.array([len(texts[k]) for k in by_group], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if len(sizes) else np.zeros(0, dtype=np.int64)
    doc = np.searchsorted(first, starts, side="right") - 1
    group = groups[by_group][doc] if len(doc) else np.zeros(0, dtype=np.int64)
    windows = np.ndarray((len(term) - 7,), dtype=">u8", buffer=term, strides=(1,))
    bucket = (lengths + 1) // 2
    for digits in range(1, 9):
        chosen = np.flatnonzero(bucket == digits)
        if not len(chosen):
            continue
        at, size = starts[chosen], lengths[chosen]
        if digits <= 4:
            words = [windows[at].astype(np.uint64) & _FIRST[size]]
        else:
            words = [windows[at].astype(np.uint64), windows[at + 8].astype(np.uint64) & _FIRST[size - 8]]
        order = _radix_order(words, digits)
        words = [word[order] for word in words]
        differs = np.logical_or.reduce([word[1:] != word[:-1] for word in words])
        g = group[chosen][order]
        runs, n, docs = _runs(differs, g, doc[chosen][order])
        yield _spelled([word[runs] for word in words]), g[runs], n, docs
    width = 16
    while width < int(lengths.max(initial=0)):
        chosen = np.flatnonzero((lengths > width) & (lengths <= 2 * width))
        width *= 2
        if len(chosen):
            view = memoryview(term)
            spelled = np.array([bytes(view[a:a + b]) for a, b in zip(starts[chosen].tolist(), lengths[chosen].tolist())], dtype=f"S{width}")
            order = np.argsort(spelled, kind="stable")
            spelled, g = spelled[order], group[chosen][order]
            runs, n, docs = _runs(spelled[1:] != spelled[:-1], g, doc[chosen][order])
            yield spelled[runs], g[runs], n, docs


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: dict[tuple[bytes, bytes], int] = {}
    parts: list[pa.Table] = []
    held = 0

    def merged() -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(parts).group_by(["term", "group"]).aggregate([("n", "sum"), ("docs", "sum")])
        keys = list(names)
        langs, sources = (pa.array([key[k] for key in keys], pa.binary()) for k in (0, 1))
        for batch in table.to_batches(max_chunksize=20_000):
            group = batch.column("group")
            columns = [langs.take(group), sources.take(group), batch.column("term"), batch.column("n_sum"), batch.column("docs_sum")]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + TEXT_BYTES, side="right")))
            part = batch.slice(at, end - at)
            at = end
            keys = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            groups = np.array([names.setdefault(key, len(names)) for key in keys], dtype=np.int64)
            for spelled, group, n, docs in count_terms(part.column("text").to_pylist(), groups):
                parts.append(pa.table([pa.array(spelled, pa.binary()), group, n, docs], ["term", "group", "n", "docs"]))
                held += len(n)
            if held >= MERGED_ROWS:
                yield from merged()
                parts, held = [], 0
                names.clear()
    if parts:
        yield from merged()


def _groups(docs: DataFrame, lang: str, source: str, text: str | None = None) -> DataFrame:
    columns = {"lang": lang, "source": source} | ({"text": text} if text else {})
    return docs.select(*(F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name) for name, column in columns.items()))


def kept_terms(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS
) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (its occurrences there, at least one), ``lang_n`` (in the whole language) and ``lead``
    (true in one row of each language and term), of terms in at least ``least`` documents of their language.

    One shuffle: each language's terms are dealt out, at most one row per term, source and task for every MERGED_ROWS.
    """
    columns = [F.col(name).cast("binary").alias(name) for name in ("lang", "source", "text")]
    rows = _groups(docs, lang, source, text).select(*columns).mapInArrow(
        _counted, "lang binary, source binary, term binary, n long, docs long"
    )
    named = rows.select(*(F.col(name).cast("string").alias(name) for name in ("lang", "source", "term")), "n", "docs")
    summed = named.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    wide = summed.withColumns({
        "lang_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term), "first": F.min("source").over(of_term),
    })
    return wide.where(F.col("lang_docs") >= least).select(
        "lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("first")).alias("lead")
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms)), exactly."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(19,0)") + SMOOTHING).cast("decimal(20,0)")
    below = (total.cast("decimal(20,0)") + (terms.cast("decimal(18,0)") * SMOOTHING)).cast("decimal(21,0)")
    return (F.call_function("div", above, below) + 1).cast("long")


def _block_sums(rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Of one block of whole terms: for each two sources the sum of what their shares differ by."""
    columns = ["lang", "a", "b", "value"]
    if not len(rows) or len(groups) < 2:
        return pd.DataFrame({name: pd.Series(dtype="int64" if name == "value" else "object") for name in columns})
    groups = groups.sort_values("source")
    names, least = groups["source"].to_numpy(), groups["none"].to_numpy(dtype=np.int64)
    number = pd.Index(names).get_indexer(rows["source"])
    term, _ = pd.factorize(rows["term"])
    order = np.argsort(term, kind="stable")
    term, number, share = term[order], number[order], rows["p"].to_numpy(dtype=np.int64)[order]
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    high = max(1, CELLS // len(names))
    for low in range(0, int(term[-1]) + 1, high):
        part = slice(*np.searchsorted(term, (low, low + high)))
        dense = np.tile(least, (min(high, int(term[-1]) + 1 - low), 1))
        dense[term[part] - low, number[part]] = share[part]
        for k in range(len(names) - 1):
            sums[k, k + 1:] += np.abs(dense[:, k + 1:] - dense[:, k:k + 1]).sum(axis=0)
    a, b = np.triu_indices(len(names), 1)
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "a": names[a], "b": names[b], "value": sums[a, b]}, columns=columns)


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, ranks: int = RANKS
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: part ``pair`` has each other source of the language with the sum
    of what the two sources' shares of kept terms differ by; part ``term`` the terms a source uses most above its language.

    A share is ``1 + floor(10^9 (n + 5) / (N + 5 V))`` for ``n`` occurrences among the ``N`` of kept terms, ``V`` in number. Ranks go
    by value descending, equal ones by item in byte order. Null texts, languages and sources are ''. Each row is a document, also if
    ids repeat. A language without kept terms has pairs of value 0; a source alone in its language has no pairs; an empty table gives
    an empty one. Other columns are ignored. A task holds one text whole; sources per language are compared all with all.
    """
    kept = stored(kept_terms(docs, lang, source, text, least), "kept-terms")
    langs = kept.groupBy("lang").agg(
        F.sum(F.col("lead").cast("long")).alias("terms"), F.sum("n").alias("lang_total"), F.count("*").alias("rows")
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        _groups(docs, lang, source).distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .fillna(0, ["terms", "lang_total", "rows", "total"]), "groups"
    )
    shares = kept.join(groups.drop("rows"), ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    above = shares.withColumn("value", F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).where("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    top = top.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)

    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.first("rows").alias("rows"), F.first("terms").alias("terms"))
    of_block = F.least(F.greatest(F.lit(BLOCK_ROWS), F.col("sources") * F.col("sources")), F.lit(MOST_BLOCK_ROWS))
    blocks = sources.where("sources > 1 and terms > 0").select("lang", F.ceil(F.col("rows") / of_block).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    rows = shares.join(blocks, "lang").select("lang", block.alias("block"), "source", "term", "p")
    none = groups.join(blocks, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source",
        _share(F.lit(0), F.col("total"), F.col("terms")).alias("none"),
    )
    sums = rows.groupBy("lang", "block").cogroup(none.groupBy("lang", "block")).applyInPandas(
        _block_sums, "lang string, a string, b string, value long"
    ).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = every.join(both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    return pairs.withColumn("rank", F.row_number().over(best)).union(top)


def result(docs: DataFrame) -> DataFrame:
    return audit(docs)


def oracle() -> str:
    upper = "".join(map(chr, range(65, 91)))
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {LEAST_DOCUMENTS}
), langs AS (
  SELECT lang, count(*)::HUGEINT AS terms, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang
), grouped AS (
  SELECT DISTINCT lang, source FROM docs
), found AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, sum(n)::HUGEINT AS total FROM found GROUP BY lang, source
), counts AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0)::HUGEINT AS n, k.lang_n, l.terms, l.lang_total, coalesce(t.total, 0)::HUGEINT AS total
  FROM grouped g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
), shares AS (
  SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + {SMOOTHING})) // (total + {SMOOTHING} * terms) AS p,
    1 + ({SCALE}::HUGEINT * (lang_n + {SMOOTHING})) // (lang_total + {SMOOTHING} * terms) AS q
  FROM counts
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM items QUALIFY part = 'pair' OR rank <= {RANKS}
"""
