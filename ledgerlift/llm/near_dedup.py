"""Near-duplicate classes by improved consistent weighted sampling (ICWS).

1. Equal texts collapse to one (MD5). Words are hashed into bins, and the number
   of documents per bin, over all documents, gives the idf of a word, smoothed to
   lie between 1 and 2. The weight of a five-word shingle is its count times the
   mean idf of its words.
2. ICWS draws one (shingle, quantised weight) per sample; two texts draw the same
   with the probability of their weighted Jaccard similarity. Four samples make a
   band, and texts that share a band become candidates.
3. Each text of a band's bucket meets the bucket's head: the text that shares the
   largest buckets overall, as an original does among its copies. Exact weighted
   Jaccard decides; linked texts form components.
4. Where a bucket still holds several components, its texts meet a second head, from
   another component than the first. Then all texts of different components whose
   samples agree often enough are compared: in buckets of up to 32 texts as pairs, in
   larger ones inside cells, bounded in texts and bytes, that return only the links they find.

So no pair rows are made in a large bucket, and texts of one component never meet in it.

Buckets are joined on their key, which Spark can split when one is hot.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlift.llm.common import U64, cut, documents, mix, stored, strings, tidy, window_hashes
from ledgerlift.llm.tfidf import bin_counts, lower_words, smooth_idf, word_bins

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
AGREE = 24  # of 48 samples; a pair at 0.8 has fewer once in ten million times
BIN_BITS = 20
FIELD = 1 << 12
CHUNK = 4096
SMALL_BUCKET = 32
CELL_TEXTS, CELL_BYTES = 4096, 4 << 20  # of a large bucket, on each side of a cell
LAST = (1 << 63) - 1
FILE_ROWS = 20_000  # of what is kept between the rounds, rows of some hundred bytes


# ---- shingles and weights ------------------------------------------------------


def weighted_shingles(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingle hashes, weights) of one text; a shorter text is one shingle."""
    if not len(words):
        return np.zeros(0, U64), np.zeros(0)
    n = min(WORDS, len(words))
    sums = np.r_[0.0, np.cumsum(idf[word_bins(words, BIN_BITS)], dtype=np.float64)]
    shingles, first, tf = np.unique(window_hashes(words, n), return_index=True, return_counts=True)
    return shingles, tf * (sums[first + n] - sums[first]) / n


def weighted_jaccard(a, b) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total > 0 else 0.0


@lru_cache(maxsize=1)
def _tables():
    """Quantiles of Gamma(2, 1), as r, 1/r and ln c, and one odd multiplier per sample."""
    grid = np.linspace(0, 30, 300_001)
    share = 1 - np.exp(-grid) * (1 + grid)
    gamma = np.interp((np.arange(FIELD) + 0.5) / FIELD, share, grid).astype(np.float32)
    keys = mix(np.arange(1, SAMPLES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    return gamma, 1 / gamma, np.log(gamma), keys


def sample(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """ICWS: per sample the shingle (with its quantised weight) of the least a = c / (y e^r)."""
    r_of, inverse, log_c, keys = _tables()
    best, drawn = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, U64)
    rows = np.arange(SAMPLES)
    for low in range(0, len(shingles), CHUNK):
        s, log_w = shingles[low : low + CHUNK], np.log(weights[low : low + CHUNK]).astype(np.float32)
        h = s[None, :] * keys[:, None]
        h ^= h >> U64(29)
        h *= U64(0xBF58476D1CE4E5B9)
        i = (h >> U64(52)).astype(np.int32)
        beta = ((h >> U64(28)) & U64(FIELD - 1)).astype(np.float32) / np.float32(FIELD)
        r = r_of[i]
        t = np.floor(log_w * inverse[i] + beta)
        a = log_c[((h >> U64(40)) & U64(FIELD - 1)).astype(np.int32)] - r * (t - beta) - r
        at = np.argmin(a, axis=1)
        least = a[rows, at]
        new = least < best
        best[new] = least[new]
        drawn[new] = mix(s[at] ^ (t[rows, at].astype(np.int64).astype(U64) * U64(0xD6E8FEB86659FD93)))[new]
    return drawn


# ---- Spark steps ---------------------------------------------------------------

SIGN = pa.schema([("tid", pa.string()), ("id", pa.int64()), ("samples", pa.list_(pa.int64()))])


def _signatures(idf: np.ndarray):
    def run(batches):
        for batch in batches:
            signed: list[np.ndarray | None] = []
            for _, words, counts in lower_words(strings(batch.column("text"))):
                ends = np.cumsum(counts)
                for a, b in zip(ends - counts, ends):
                    signed.append(sample(*weighted_shingles(words[a:b], idf)).view(np.int64) if b > a else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), batch.column("id"), pa.array(signed, SIGN.field("samples").type)], schema=SIGN
            )

    return run


def _verify(idf: np.ndarray):
    def run(batches):
        for batch in batches:
            vectors = []
            for side in ("a_text", "b_text"):
                own = []
                for _, words, counts in lower_words(strings(batch.column(side))):
                    ends = np.cumsum(counts)
                    own.extend(weighted_shingles(words[x:y], idf) for x, y in zip(ends - counts, ends))
                vectors.append(own)
            near = pa.array([weighted_jaccard(a, b) >= SIMILARITY for a, b in zip(*vectors)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return run


LINK = pa.schema([("a", pa.string()), ("b", pa.string())])


def cell_links(vectors: list, samples: np.ndarray, labels: list, other: np.ndarray, band: int):
    """(i, j) of links that join the labels of a cell; where ``other`` differs anywhere, only texts on different sides meet.

    Pairs that share an earlier band are left to its bucket, which holds both.
    """
    sizes = np.array([len(s) for s, _ in vectors])
    start = np.cumsum(sizes) - sizes
    kinds, codes = np.unique(np.concatenate([s for s, _ in vectors]), return_inverse=True)
    weights = np.concatenate([w for _, w in vectors])
    total = np.array([w.sum() for _, w in vectors])
    label = np.unique(labels, return_inverse=True)[1]
    dense, crossed, places = np.zeros(len(kinds)), other.any() and not other.all(), np.arange(len(sizes))
    for i in range(len(sizes)):
        met = np.flatnonzero((label != label[i]) & ((other & ~other[i]) if crossed else (places > i)))
        met = met[np.minimum(total[met], total[i]) >= SIMILARITY * (1 - 1e-9) * np.maximum(total[met], total[i])]
        same = samples[met] == samples[i]
        first = same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
        met = met[(same.sum(axis=1) >= AGREE) & (first == band)]
        if not len(met):
            continue
        mine = slice(start[i], start[i] + sizes[i])
        dense[codes[mine]] = weights[mine]
        edge = np.cumsum(sizes[met]) - sizes[met]
        at = np.arange(sizes[met].sum()) + np.repeat(start[met] - edge, sizes[met])
        both = np.add.reduceat(np.minimum(weights[at], dense[codes[at]]), edge)
        dense[codes[mine]] = 0
        for j in met[both >= SIMILARITY * (total[met] + total[i] - both)]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                yield i, int(j)


def _cell(idf: np.ndarray):
    def run(cell: pa.Table) -> pa.Table:
        vectors = []
        for _, words, counts in lower_words(strings(cell.column("text"))):
            ends = np.cumsum(counts)
            vectors.extend(weighted_shingles(words[x:y], idf) for x, y in zip(ends - counts, ends))
        samples = cell.column("samples").combine_chunks().flatten().to_numpy().reshape(-1, SAMPLES)
        tid, band = cell.column("tid").to_pylist(), cell.column("band")[0].as_py()
        other = cell.column("other").to_numpy(zero_copy_only=False).astype(bool)
        links = list(cell_links(vectors, samples, cell.column("label").to_pylist(), other, band))
        return pa.table([[tid[i] for i, _ in links], [tid[j] for _, j in links]], schema=LINK)

    return run


def _cells(left: DataFrame) -> DataFrame:
    """Rows (bucket, first, label, tid, size, ...) of large buckets, once per cell in which they take part.

    Texts outside the bucket's first component (``out``) meet each other and all texts of it, block by
    block. Blocks are bounded by texts and by bytes, so a text is sent as often as its bucket has blocks.
    """

    def blocks(side: Column) -> Column:
        size = F.coalesce(F.sum(F.when(side, F.col("size"))), F.lit(0))
        return F.greatest(F.ceil(F.count_if(side) / CELL_TEXTS), F.ceil(size / CELL_BYTES)).cast("int")

    sizes = left.groupBy("bucket").agg(
        blocks(F.col("label") != F.col("first")).alias("outs"), blocks(F.col("label") == F.col("first")).alias("ins")
    )
    out, block = F.col("label") != F.col("first"), F.xxhash64("tid", "bucket")
    rows = left.join(sizes, "bucket").withColumn("block", F.when(out, F.pmod(block, "outs")).otherwise(F.pmod(block, "ins")).cast("int"))
    outs, ins = (F.sequence(F.lit(0), F.col(x) - 1) for x in ("outs", "ins"))

    def cell(kind: int, i: Column, j: Column, other: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), other.alias("other"))

    mine = F.col("block")
    among = F.transform(outs, lambda x: cell(0, F.least(x, mine), F.greatest(x, mine), x < mine))
    across = F.transform(ins, lambda y: cell(1, mine, y, F.lit(False)))
    into = F.transform(outs, lambda x: cell(1, x, mine, F.lit(True)))
    cells = F.when(out, F.concat(among, across)).otherwise(into)
    return rows.withColumn("cell", F.explode(cells)).select("*", "cell.*").drop("cell", "block", "outs", "ins")


def _agreement(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most about ``rows`` rows, in as many partitions as these ask for: few rows leave few files."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component, for the nodes of ``edges`` (a, b), which is read twice."""
    most = edges.count()
    labels, left = None, cut(_files(edges.filter("a <> b").select("a", "b").distinct(), most))
    while not left.isEmpty():
        ways = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = ways.groupBy("a").agg(F.least("a", F.min("b")).alias("up")).withColumnRenamed("a", "node")
        for _ in range(2):  # jump to the parent's parent
            upper = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = parent.join(upper, "up").select("node", F.col("top").alias("up"))
        parent = cut(_files(parent, 2 * most))
        if labels is None:
            labels = parent.withColumnRenamed("up", "label")
        else:
            moved = parent.select(F.col("node").alias("label"), "up")
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("up", "label").alias("label"))
        up_a = parent.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        up_b = parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        moved = left.join(up_a, "a").join(up_b, "b").filter("ua <> ub")
        left = cut(_files(moved.select(F.col("ua").alias("a"), F.col("ub").alias("b")).distinct(), most))
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` with tid (what tells texts apart) and id (the doc_id; the greatest where there is none)."""
    return docs.withColumns({
        "tid": F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")),
        "id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)),
    })


def _classes(rows: DataFrame) -> DataFrame:
    """(tid, id, label) of every distinct text of rows (tid, id, text); equal labels are one class."""
    held, n = bin_counts(rows, BIN_BITS)
    idf = smooth_idf(held, n)
    signed = rows.select("tid", "id", "text").mapInArrow(tidy(_signatures(idf)), "tid string, id bigint, samples array<bigint>")
    texts = cut(_files(signed.groupBy("tid").agg(F.min("id").alias("id"), F.any_value("samples").alias("samples")), n))

    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.slice("samples", i * ROWS + 1, F.lit(ROWS))),
    )
    keyed = texts.filter("samples IS NOT NULL").select("tid", F.posexplode(band).alias("band", "bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    paired = keyed.join(shared, "bucket")
    rank = paired.groupBy("tid").agg(F.sum("n").alias("rank"))  # an original shares larger buckets than its copies
    members = cut(_files(paired.join(rank, "tid"), BANDS * n // 4))
    met_rows = members.count()

    # the texts of all candidates, once for all rounds
    where = members.select("tid").distinct().join(texts.select("tid", "id"), "tid")
    found = rows.select("tid", "id", "text").join(where, ["tid", "id"]).dropDuplicates(["tid", "id"])
    found = stored(_files(found.select("tid", "text"), n))
    a_side, b_side = (found.select(F.col("tid").alias(x), F.col("text").alias(f"{x}_text")) for x in "ab")

    def verified(pairs: DataFrame) -> DataFrame:
        met = pairs.distinct().join(a_side, "a").join(b_side, "b").select("a", "b", "a_text", "b_text")
        near = met.mapInArrow(tidy(_verify(idf)), "a string, b string")
        return cut(near.repartition(max(1, -(-met_rows // FILE_ROWS))))

    heads = members.groupBy("bucket").agg(F.max(F.struct("rank", "tid")).alias("head")).select("bucket", "head.tid")
    meet = members.join(heads.withColumnRenamed("tid", "a"), "bucket").filter("tid <> a")
    links = verified(meet.select("a", F.col("tid").alias("b")))
    labels = components(links)

    for small in (False, True):
        grouped = members.join(labels.withColumnRenamed("node", "tid"), "tid", "left").select(
            "bucket", "band", "tid", "rank", "n", F.coalesce("label", "tid").alias("label")
        )
        several = grouped.groupBy("bucket").agg(
            F.min("label").alias("x"), F.max("label").alias("y"), F.max(F.struct("rank", "tid", "label")).alias("head")
        ).filter("x <> y").select("bucket", F.col("head.label").alias("first"))
        left = cut(_files(grouped.join(several, "bucket"), met_rows))
        if small:
            left = left.join(texts.select("tid", "samples"), "tid")
            few = left.filter(F.col("n") <= SMALL_BUCKET)
            a = few.select("bucket", F.col("tid").alias("a"), F.col("label").alias("la"), F.col("samples").alias("sa"))
            b = few.select("bucket", F.col("tid").alias("b"), F.col("label").alias("lb"), F.col("samples").alias("sb"))
            meet = a.join(b, "bucket").filter((F.col("la") < F.col("lb")) & (_agreement(F.col("sa"), F.col("sb")) >= AGREE))
            sized = found.select("tid", F.octet_length("text").alias("size"))
            cells = _cells(left.filter(F.col("n") > SMALL_BUCKET).join(sized, "tid")).join(found, "tid")
            linked = cells.groupBy("bucket", "kind", "i", "j").applyInArrow(_cell(idf), "a string, b string")
            links = links.unionByName(cut(linked.repartition(max(1, -(-met_rows // FILE_ROWS)))))
        else:
            second = left.filter("label <> first").groupBy("bucket").agg(F.max(F.struct("rank", "tid", "label")).alias("s"))
            second = second.select("bucket", F.col("s.tid").alias("a"), F.col("s.label").alias("la"))
            meet = left.join(second, "bucket").filter("label <> la").select("a", F.col("tid").alias("b"))
        links = links.unionByName(verified(meet.select("a", "b")))
        labels = components(links)

    return texts.select("tid", "id").join(labels.withColumnRenamed("node", "tid"), "tid", "left").select(
        "tid", "id", F.coalesce("label", "tid").alias("label")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) per row: class_id is the least doc_id of the row's class.

    Texts are linked if their weighted Jaccard similarity over TF-IDF weighted
    five-word shingles is 0.8 or more; classes are the connected components. Words
    are runs of bytes other than ASCII white space, with A-Z lowered.

    Equal texts share a class. A text of fewer than five words is one shingle. A
    text without words is alike only to the very same text; null counts as empty.
    Rows may repeat, share a doc_id or lack one; a class of rows without ids has a
    null class_id. Candidates come from 12 bands of 4 samples: a pair at 0.8 is
    missed about twice in a thousand times, at 0.9 never in practice. All candidates of
    different components are compared, whatever the size of their bucket.
    """
    rows = _identified(documents(docs))
    classes = _classes(rows.select("tid", "id", F.coalesce("text", F.lit("")).alias("text")))
    least = classes.groupBy("label").agg(F.min("id").alias("class_id"))
    of = classes.join(least, "label").select("tid", F.nullif("class_id", F.lit(LAST)).alias("class_id"))
    return rows.select("doc_id", "tid").join(of, "tid").select("doc_id", "class_id")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs``, all columns, per class: that of the least doc_id; see near_duplicates."""
    rows = _identified(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    kept = _classes(rows.select("tid", "id", "text")).groupBy("label").agg(F.min(F.struct("id", "tid")).alias("k")).select("k.id", "k.tid")
    taken = _identified(docs).withColumnsRenamed({"tid": "_tid", "id": "_id"})
    one = taken.join(kept, (F.col("_tid") == F.col("tid")) & (F.col("_id") == F.col("id")))
    return one.dropDuplicates(["_tid", "_id"]).select(*[F.col(f"`{c}`") for c in docs.columns])
