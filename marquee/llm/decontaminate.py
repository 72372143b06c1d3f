"""Operator 6: benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows; a window's tokens are its word
shingles, ordered by how rare they are in all documents.  A document that
holds the window holds all its shingles, so it holds the rarest one: that
prefix is all that is joined.  What joins must leave room for the whole window
before and after (length and position), and is then compared word by word.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import carried, lean, same_document, written
from marquee.llm.words import flat, shingle_hashes, slices, word_hashes, word_spans

WINDOW = 13
SHINGLE = 5
#: Slots of the filter that documents are scanned with: 4 Mbit whatever the benchmark's size.
FILTER_BITS = 22


def _words(column):
    """Per slice of rows: (first row, row count, low bytes, starts, ends, row of each word, hashes)."""
    data, offs = flat(column)
    for i0, i1 in slices(offs):
        sub, lo = data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0]
        low, s, e = word_spans(sub, lo)
        yield i0, i1 - i0, low, s, e, np.searchsorted(lo, s, "right") - 1, word_hashes(low, s, e)


def _joined(low, starts, ends, a, b) -> str:
    return b" ".join(low[starts[k]:ends[k]].tobytes() for k in range(a, b)).decode()


def _windows(window, shingle, batches):
    """(item_id, words, length) of every window of every item."""
    for b in batches:
        ids, texts, lengths = [], [], []
        for i0, n, low, s, e, row, _ in _words(b.column("text")):
            cut = np.searchsorted(row, np.arange(n + 1))
            for i in range(n):
                a, z = int(cut[i]), int(cut[i + 1])
                for w in range(a, max(a + 1, z - window + 1)) if z > a else ():
                    ids.append(i0 + i)
                    texts.append(_joined(low, s, e, w, min(w + window, z)))
                    lengths.append(min(window, z - a))
        yield pa.RecordBatch.from_arrays([b.column("item_id").take(pa.array(ids, pa.int64())), pa.array(texts, pa.string()), pa.array(lengths, pa.int32())],
                                         names=["item_id", "words", "length"])


def _window_tokens(shingle, batches):
    """(window, size, place, token) of every shingle of every window."""
    for b in batches:
        win, size, place, token = [], [], [], []
        ids = b.column("window_id").to_numpy()
        for i0, n, _, _, _, row, h in _words(b.column("words")):
            cut = np.searchsorted(row, np.arange(n + 1))
            for i in range(n):
                hs = h[cut[i]:cut[i + 1]]
                g = min(shingle, len(hs))
                t, at = shingle_hashes(hs, np.zeros(len(hs), np.int8), g)
                win += [ids[i0 + i]] * len(t)
                size += [g] * len(t)
                place += at.tolist()
                token.append(t)
        t = np.concatenate(token) if token else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(win, pa.int64()), pa.array(size, pa.int32()), pa.array(place, pa.int32()), pa.array(t.view(np.int64))],
                                         names=["window_id", "size", "place", "token"])


def _filter(tokens: DataFrame):
    """A fixed-size bitmap of the tokens' hashes, and the shingle sizes in use.
    At most 2^FILTER_BITS slot numbers come to the driver, whatever the input."""
    slot = F.shiftrightunsigned(F.col("token"), 64 - FILTER_BITS).cast("int").alias("slot")
    got = tokens.select(slot).distinct().toArrow().column("slot").to_numpy()
    bitmap = np.zeros(1 << FILTER_BITS, bool)
    bitmap[got] = True
    sizes = sorted(r["size"] for r in tokens.select("size").distinct().collect())
    return np.packbits(bitmap), sizes


def _passing(bits, h, row, sizes):
    """(token, start, size) of the document shingles that pass the filter."""
    for g in sizes:
        t, at = shingle_hashes(h, row, g)
        ok = bits[(t >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
        yield g, t[ok], at[ok]


def _rarity(shared, batches):
    """(token, n): occurrences in the documents of the tokens that pass."""
    packed, sizes = shared.value
    bits = np.unpackbits(packed).astype(bool)
    for b in batches:
        found = [t for _, _, _, _, _, row, h in _words(b.column("text")) for _, t, _ in _passing(bits, h, row, sizes)]
        t, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])


def _candidates(shared, window, batches):
    """Per document its number of words, and the places of prefix tokens with
    the words around them."""
    packed, sizes = shared.value
    bits = np.unpackbits(packed).astype(bool)
    place = pa.struct([("token", pa.int64()), ("at", pa.int64()), ("from", pa.int64()), ("words", pa.string())])
    row_id = TaskContext.get().partitionId() << 33
    for b in batches:
        n_words, cands = np.zeros(b.num_rows, np.int64), [None] * b.num_rows
        for i0, n, low, s, e, row, h in _words(b.column("text")):
            cut = np.searchsorted(row, np.arange(n + 1))
            n_words[i0:i0 + n] = np.diff(cut)
            for _, tokens, at in _passing(bits, h, row, sizes):
                for t, k in zip(tokens.view(np.int64).tolist(), at.tolist(), strict=True):
                    r = int(row[k])
                    lo, hi = max(int(cut[r]), k - window + 1), min(int(cut[r + 1]), k + window)
                    cands[i0 + r] = cands[i0 + r] or []
                    cands[i0 + r].append({"token": t, "at": k - int(cut[r]), "from": lo - int(cut[r]), "words": _joined(low, s, e, lo, hi)})
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(row_id, row_id + b.num_rows)), b.column("doc_id"), b.column("text_key"), pa.array(n_words), pa.array(cands, pa.list_(place))],
            names=["row_id", "doc_id", "text_key", "n_words", "places"])
        row_id += b.num_rows


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: int = 20) -> DataFrame:
    """One row per input row: doc_id, text_key, n_words, n_hit (words inside
    any occurrence of a window), n_items, items_sha256 (digest of the ids of
    the items with occurring windows, sorted as text), contaminated (n_hit > 0
    and ``share`` * n_hit >= n_words).

    Words are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased.  A window is ``window`` consecutive words of an item, or the
    whole of a shorter item; items without words have none.  Null and empty
    texts have no words and no hits; repeated documents repeat; repeated
    items, ids and windows count once; very long texts are compared whole, their
    hits are put together in one task; a null item id counts as its own item,
    written as an empty string; empty tables give no rows or no hits; other
    columns are not read.

    Everything that is broadcast is the fixed-size filter; what passes it is
    joined by shuffle, so a large benchmark needs no other way.
    """
    spark = docs.sparkSession
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", "text").mapInArrow(lean(partial(_windows, window, shingle)), f"item_id {item_type}, words string, length int")
    rows = written(rows.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "words", "length").distinct(), "decon-rows")
    windows = written(rows.select("words", "length").distinct().withColumn("window_id", F.monotonically_increasing_id()), "decon-windows")
    members = rows.join(windows, ["words", "length"]).select("window_id", "item")
    tokens = written(windows.select("window_id", "words").mapInArrow(lean(partial(_window_tokens, shingle)), "window_id long, size int, place int, token long"), "decon-tokens")

    slim = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    scan = spark.sparkContext.broadcast(_filter(tokens))
    rarity = slim.select("text").mapInArrow(lean(partial(_rarity, scan)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rarity = written(rarity, "decon-rarity")
    # the rarest token of each window; a token that no document holds rules the window out
    ranked = tokens.join(rarity, "token", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place", "size")).alias("p")).where("p.n > 0")
    prefixes = written(ranked.select("window_id", "p.token", "p.place", "p.size").join(windows, "window_id"), "decon-prefixes")

    prefix_scan = spark.sparkContext.broadcast(_filter(prefixes))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    base = written(slim.mapInArrow(lean(partial(_candidates, prefix_scan, window)),
                                   f"row_id long, doc_id {id_type}, text_key long, n_words long, places array<struct<token:long,at:long,from:long,words:string>>"), "decon-places")
    places = base.where(F.size("places") > 0).select("row_id", "n_words", F.explode("places").alias("c")).select("row_id", "n_words", "c.*")
    start = F.col("at") - F.col("place")
    around = F.slice(F.split("around", " "), (start - F.col("from") + 1).cast("int"), F.col("length"))
    # an occurrence under several tokens or windows of one text is one hit
    hits = (places.withColumnRenamed("words", "around").join(prefixes, "token")
            .where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
            .where(F.array_join(around, " ") == F.col("words"))
            .select("row_id", "window_id", start.alias("start"), (start + F.col("length")).alias("end")).distinct())
    hits = written(hits, "decon-hits")
    before = Window.partitionBy("row_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = (hits.select("row_id", "start", "end").distinct()
               .withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0).cast("long")))
               .groupBy("row_id").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))).alias("n_hit")))
    items = (hits.select("row_id", "window_id").distinct().join(members, "window_id").groupBy("row_id")
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (base.select("row_id", "doc_id", "text_key", "n_words").join(covered, "row_id", "left").join(items, "row_id", "left")
            .select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                    F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
                    ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    bad = contamination(docs, benchmark, window, shingle, share).where("contaminated").select("doc_id", "text_key").distinct()
    bad, match = same_document(bad)
    return carried(docs).join(bad, match, "left_anti").select("row.*")
