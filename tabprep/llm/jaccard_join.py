"""N-gram Jaccard join by count vectors and R-trees: which documents are near copies of one another.

A document is its set of word shingles, hashed to 64 bits. The sum of its mixed hashes is the set's
fingerprint; documents with equal fingerprints are one class. The join finds all classes that are
linked, in four steps that Spark distributes.

1. *Slices of the count vector.* Shingles are hashed into groups and the groups into blocks. Linked
   sets differ in at most d shingles, so among enough blocks some block of more than a few shingles
   is the same in both; its count vector, hashed, is a page. Sizes are cut into bands, each with its
   own number of blocks; a set enters its own band and the next one if a linked set may be there.
   Every linked pair meets in a page. Sets too uneven for that guarantee enter all their blocks.
2. *Bound.* The classes of a page with two or more carry their whole count vectors; an R-tree skips
   pairs whose summed smaller counts are below the overlap a link needs. What remains is connected.
3. *Verify.* Each connected group is brought together with its texts, an R-tree is built over the
   count vectors again, and surviving pairs are decided on the sets themselves.
4. *Components* of verified links, then of documents.

Pairs are never all emitted: a task emits links that connect what all its links connect. A page or
group above ``chunk`` members is dealt out as pairs of chunks, so no task holds more than two.
A 64-bit hash stands for a shingle and for a set; a chance collision is the only inexactness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm import rtree, scan
from tabprep.llm.graph import components
from tabprep.llm.staging import Scratch, even_keys, prefiltered

#: Members of a page or group that one task takes from one side.
CHUNK = 2000
#: Text bytes whose slices are sent on together.
FLUSH_BYTES = 4 << 20
#: Vector groups: a power of two near a quarter of the set size, within these limits.
LEAST_GROUPS, MOST_GROUPS = 16, 512


def bands(percent: int, most: int = 1 << 40) -> list[tuple[int, int, int, int]]:
    """Size bands as (least size, differing shingles d, blocks, least block content).

    For sizes a <= b in the band of b, sets that reach the similarity differ in at most
    (a + b)(1 - t) / (1 + t) shingles, where t is the similarity.
    """
    out, at = [], 1
    while at < most:
        above = max(at + 1, at * 5 // 4)
        d = 2 * (above - 1) * (100 - percent) // (100 + percent)
        content = 4 if percent >= 90 else 2
        blocks = int(1.25 * d + 1.5 * np.sqrt(d)) + 4
        out.append((at, d, blocks, content))
        at = above
    return out


def _sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    starts, ends, first = scan.word_bounds(~scan.SPACE[raw], offsets)
    words = scan.word_hashes(raw, starts, ends)
    for i in range(len(offsets) - 1):
        yield np.unique(scan.shingle_hashes(words[first[i] : first[i + 1]], size))


def fingerprint(shingles: np.ndarray) -> np.uint64:
    return scan.mix(shingles).sum(dtype=np.uint64)


def groups_of(size: int) -> int:
    return 1 << max(LEAST_GROUPS.bit_length() - 1, min(MOST_GROUPS.bit_length() - 1, int(size // 4).bit_length()))


def packed_counts(shingles: np.ndarray) -> bytes:
    """The count vector of one set, in the least width that holds its largest count."""
    counts = rtree.count_vectors([shingles], groups_of(len(shingles)))[0]
    most = counts.max()
    return counts.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


#: Groups of one block: many, so that few shingles already tell slices apart.
_SLICE_GROUPS = np.uint64(1 << 20)


def slice_keys(shingles: np.ndarray, number: int, d: int, blocks: int, content: int) -> np.ndarray:
    """The pages of one set in one band: hashes of the count vectors of its blocks."""
    if not d:
        return np.zeros(0, np.uint64)  # only equal sets link
    block = (((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)
    filled = np.bincount(block, minlength=blocks)
    total = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(scan.mix(shingles & (_SLICE_GROUPS - np.uint64(1))), out=total[1:])
    ends = np.cumsum(filled)
    keys = scan.mix((total[ends] - total[ends - filled]) ^ scan.mix(np.arange(blocks, dtype=np.uint64) * np.uint64(4096) + np.uint64(number)))
    for least in range(content, -1, -1):
        kept = filled >= least
        if kept.sum() > d:
            return keys[kept]
    return keys


def page_keys(shingles: np.ndarray, percent: int, table: list[tuple[int, int, int, int]], least: np.ndarray) -> np.ndarray:
    """All pages of one set: of its own band, and of those where a linked larger set may be."""
    band = int(np.searchsorted(least, len(shingles), "right")) - 1
    found = [slice_keys(shingles, band, *table[band][1:])]
    while least[band + 1] * percent <= 100 * len(shingles):
        band += 1
        found.append(slice_keys(shingles, band, *table[band][1:]))
    return np.concatenate(found)


_BLOBS = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("sets", pa.binary()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()), ("vector", pa.binary())])
BLOBS = "bucket int, keys binary, sets binary, doc_id long, n_shingles long, set_id long, vector binary"


def _signed(size: int, percent: int, bucket_keys: list[int]):
    """Documents to their records, and to pages: one row for each bucket and flush, with packed keys."""
    buckets = len(bucket_keys)
    table = bands(percent, 1 << 32)
    least_of = np.array([b[0] for b in table])

    def flush(keys: list[np.ndarray], owners: list[np.ndarray], ids: list[int]) -> Iterator[dict]:
        key, owner, known = np.concatenate(keys), np.concatenate(owners), np.array(ids, np.uint64)
        bucket = (key % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        key, owner = key[order], owner[order]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            k, o = key[cuts[b] : cuts[b + 1]], owner[cuts[b] : cuts[b + 1]]
            used, local = np.unique(o, return_inverse=True)
            packed = (k >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            yield {"bucket": bucket_keys[b], "keys": packed.tobytes(), "sets": np.uint32(len(used)).tobytes() + known[used].tobytes() + local.astype("<u2" if len(used) <= 65536 else "<u4").tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        ids: list[int] = []
        here: dict[int, int] = {}
        held = 0
        for rows, raw, offsets in scan.slices(batches, "text"):
            records = []
            for doc_id, shingles in zip(rows.column("doc_id").to_pylist(), _sets(raw, offsets, size)):
                n = len(shingles)
                mark = int(fingerprint(shingles)) if n else 0
                vector = None
                if n and mark not in here:
                    here[mark] = len(ids)
                    found = page_keys(shingles, percent, table, least_of)
                    if len(found):
                        keys.append(found)
                        owners.append(np.full(len(found), len(ids), np.int64))
                    ids.append(mark)
                if n:
                    vector = packed_counts(shingles)
                records.append({"bucket": bucket_keys[len(records) % buckets], "doc_id": doc_id, "n_shingles": n, "set_id": int(np.uint64(mark).astype(np.int64)), "vector": vector})
            yield pa.RecordBatch.from_pylist(records, _BLOBS)
            held += len(raw)
            if held >= FLUSH_BYTES:
                if keys:
                    yield pa.RecordBatch.from_pylist(list(flush(keys, owners, ids)), _BLOBS)
                keys, owners, ids, here, held = [], [], [], {}, 0
        if keys:
            yield pa.RecordBatch.from_pylist(list(flush(keys, owners, ids)), _BLOBS)
        keys, owners, ids, here = [], [], [], {}
        scan.tidy()

    return run


_RECORDS = pa.schema([("kind", pa.int32()), ("page", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()), ("vector", pa.binary())])
RECORDS = "kind int, page long, doc_id long, n_shingles long, set_id long, vector binary"


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages of one partition's buckets that hold two classes or more; document records pass through."""
    keys, sets = [], []
    for batch in batches:
        is_blob = pc.is_valid(batch.column("keys"))
        records = batch.filter(pc.invert(is_blob))
        if records.num_rows:
            zero = pa.array(np.zeros(records.num_rows, np.int32))
            yield pa.RecordBatch.from_arrays([zero, pa.nulls(records.num_rows, pa.int64()), *(records.column(c) for c in ("doc_id", "n_shingles", "set_id", "vector"))], schema=_RECORDS)
        blobs = batch.filter(is_blob)
        for bucket, packed, owners in zip(blobs.column("bucket"), blobs.column("keys"), blobs.column("sets")):
            wide = np.zeros((len(packed.as_buffer()) // 5, 8), np.uint8)
            wide[:, :5] = np.frombuffer(packed.as_buffer(), np.uint8).reshape(-1, 5)
            keys.append((np.uint64(bucket.as_py()) << np.uint64(40)) | wide.view("<u8").ravel())
            data = np.frombuffer(owners.as_buffer(), np.uint8)
            known = int(data[:4].view("<u4")[0])
            ids = np.frombuffer(data[4 : 4 + 8 * known].tobytes(), "<u8")
            sets.append(ids[np.frombuffer(data[4 + 8 * known :].tobytes(), "<u2" if known <= 65536 else "<u4")])
    if not keys:
        return
    key, owner = np.concatenate(keys), np.concatenate(sets)
    del keys, sets
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    counts = np.diff(np.r_[starts, len(key)])
    page = np.repeat(np.arange(len(starts)), counts)
    shared = np.repeat(counts > 1, counts)
    page, owner = page[shared], owner[shared]
    order = np.lexsort((owner, page))
    page, owner = page[order], owner[order]
    first = np.r_[True, (page[1:] != page[:-1]) | (owner[1:] != owner[:-1])] if len(page) else np.zeros(0, bool)
    page, owner = page[first], owner[first]
    if not len(page):
        return
    starts = np.flatnonzero(np.r_[True, page[1:] != page[:-1]])
    counts = np.diff(np.r_[starts, len(page)])
    # a page is named by its members: pages with the same members are one
    name = np.repeat(np.add.reduceat(scan.mix(owner), starts), counts)
    many = np.repeat(counts > 1, counts)
    name, owner = name[many], owner[many]
    if not len(name):
        return
    order = np.lexsort((owner, name))
    name, owner = name[order], owner[order]
    first = np.r_[True, (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])]
    name, owner = name[first].view(np.int64), owner[first].view(np.int64)
    for at in range(0, len(name), 100_000):
        part, marks = name[at : at + 100_000], owner[at : at + 100_000]
        n = len(part)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.array(part), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(marks), pa.nulls(n, pa.binary())], schema=_RECORDS)
    del name, owner, part, marks
    scan.tidy()


def _dealt(members: DataFrame, group: str, chunk: int) -> DataFrame:
    """Rows with the unit of work they go to; a group above ``chunk`` becomes pairs of its chunks.

    ``unit`` names the task's group, ``side`` is 0 or 1 in a pair of unlike chunks and null where all
    members meet one another. The number of chunks comes from a count that is combined before it is
    shuffled, and the join back is one that Spark can split.
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("_size")).where(F.col("_size") > chunk)
    sizes = sizes.select(group, F.ceil(F.col("_size") / F.lit(chunk)).cast("int").alias("_chunks"))
    own = F.pmod(F.xxhash64(F.lit(5), "set_id"), F.col("_chunks")).cast("int")
    rows = members.join(sizes, group, "left").withColumn("_own", own)
    other = F.when(F.col("_chunks").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("_chunks") - 1))
    rows = rows.withColumn("_other", F.explode(other))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    alike = F.col("_other").isNull() | (F.col("_own") == F.col("_other"))
    return rows.select(*members.columns, low.alias("low"), high.alias("high"), F.when(~alike, (F.col("_own") > F.col("_other")).cast("int")).alias("side"))


def _flat(columns: list[Column], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _folded(vector: bytes, size: int, groups: int) -> np.ndarray:
    """The counts of a set of ``size`` shingles by ``groups`` groups, no more than it was packed with."""
    v = np.frombuffer(vector, f"<u{len(vector) // groups_of(size)}").astype(np.int32)
    return v if len(v) == groups else v.reshape(groups, -1).sum(axis=1)


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Whole groups of equal ``column`` out of rows that are sorted by it, some thousand rows together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(values[1:] != values[:-1])
        if held and held[-1].column(column)[-1].as_py() != values[0]:
            cut = 0
        elif len(change):
            cut = int(change[0]) + 1
        else:
            held.append(batch)
            continue
        last = int(change[-1]) + 1 if len(change) else 0
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, max(cut, last))])
        held = [batch.slice(max(cut, last))]
    if held:
        yield pa.Table.from_batches(held)


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = np.array(pairs, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=_LINKS)


def _bounded(percent: int):
    """Units of page members to links between classes that the bound on whole count vectors allows."""

    def connect(marks, sizes, vectors, sides) -> list[tuple[int, int]]:
        groups = groups_of(min(sizes))
        points = np.array([_folded(v, n, groups) for v, n in zip(vectors, sizes)], np.int32)
        tree = rtree.CountTree(points, sizes, percent) if len(marks) > 8 else None
        label = np.arange(len(marks))
        found = []
        for i in range(len(marks)):
            if tree is not None:
                near = tree.search(points[i], sizes[i])
                near = near[near > i]
            else:
                near = np.arange(i + 1, len(marks))
                near = near[np.minimum(points[i], points[near]).sum(axis=1) >= rtree.needed(sizes[i], sizes[near], percent)]
            if sides is not None:
                near = near[sides[near] != sides[i]]
            if len(near):
                for other in set(label[near].tolist()) - {int(label[i])}:
                    found.append((marks[i], marks[near[label[near] == other][0]]))
                    label[label == other] = label[i]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "unit"):
            unit = table.column("unit").to_numpy()
            marks, sizes = table.column("set_id").to_numpy(), table.column("n_shingles").to_numpy()
            vectors, side = table.column("vector").to_pylist(), table.column("side").to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.flatnonzero(unit[1:] != unit[:-1]) + 1, len(unit)]
            found = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                sides = None if np.isnan(np.asarray(side[a:b], float)).all() else np.asarray(side[a:b], float)
                found += connect(marks[a:b], sizes[a:b], vectors[a:b], sides)
            if found:
                yield _links(list(set(found)))

    return run


def _verified(size: int, percent: int):
    """Units of documents to links verified on their shingle sets; copies of one set count once."""

    def solve(texts) -> list[tuple[int, int]]:
        sets, marks, sides, seen = [], [], [], set()
        for mark, side, shingles in texts:
            if (mark, side) not in seen and int(fingerprint(shingles).astype(np.int64)) == mark:
                seen.add((mark, side))
                sets.append(shingles)
                marks.append(mark)
                sides.append(side)
        split = np.array([-1 if s is None else s for s in sides])
        return [(marks[i], marks[j]) for i, j in rtree.spanning_links(sets, percent, split if (split >= 0).any() else None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "unit"):
            unit = table.column("unit").to_numpy()
            cuts = np.r_[0, np.flatnonzero(unit[1:] != unit[:-1]) + 1, len(unit)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = table.slice(a, b - a).to_batches()
                texts = ((mark, side, shingles) for rows, raw, offsets in scan.slices(iter(part), "text") for mark, side, shingles in zip(rows.column("set_id").to_pylist(), rows.column("side").to_pylist(), _sets(raw, offsets, size)))
                found = solve(texts)
                if found:
                    yield _links(found)

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` long, ``text``): ``doc_id``, ``n_shingles``, ``component_id``.

    Texts are lower-cased (A-Z) and cut at ASCII white space. Two documents link when their sets of
    ``shingle``-word shingles reach a Jaccard similarity of ``percent`` / 100; a shorter document is
    one shingle. ``component_id`` is the smallest ``doc_id`` reachable by links. A null, empty or
    blank text has no shingles, links with nothing and stands in its own component. Repeated ids are
    rows of their own; a null id stays null and is smallest only where no other id is in the
    component. An empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 2 * parts
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = docs.mapInArrow(_signed(shingle, percent, even_keys(spark, buckets)), BLOBS)
    found = scratch.write(signed.repartition(buckets, "bucket").mapInArrow(_pages, RECORDS))
    records = found.where("kind = 0").select("doc_id", "n_shingles", "set_id", "vector")
    pages = found.where("kind = 1").select("page", "set_id").distinct()

    classes = records.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    vectors = prefiltered(records.where("n_shingles > 0"), "set_id", pages.select("set_id"))
    vectors = vectors.groupBy("set_id").agg(F.first("n_shingles").alias("n_shingles"), F.first("vector").alias("vector"))
    members = _dealt(pages, "page", chunk).join(vectors, "set_id")
    members = members.select(_flat([F.col("page"), F.col("low"), F.col("high")], 1).alias("unit"), "side", "set_id", "n_shingles", "vector")
    near = members.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(_bounded(percent), "u long, v long")
    groups = scratch.write(components(near))

    dealt = _dealt(groups.select(F.col("node").alias("set_id"), "label"), "label", chunk)
    wanted = dealt.join(classes, "set_id")
    wanted = wanted.select(_flat([F.col("label"), F.col("low"), F.col("high")], 2).alias("unit"), "side", "set_id", "rep")
    wanted = scratch.write(wanted)
    texts = prefiltered(docs, "doc_id", wanted.select("rep"))
    joined = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.rep)).select("unit", "side", "set_id", "text")
    links = joined.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(_verified(shingle, percent), "u long, v long")
    final = scratch.write(components(links))
    scratch.drop(groups, wanted)

    named = classes.join(final, classes.set_id == final.node, "left")
    named = named.select("set_id", "rep", F.coalesce("label", "set_id").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "label").select("set_id", "component_id")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    # rows without shingles have the set id 0 and match no class
    return records.join(named, "set_id", "left").select("doc_id", "n_shingles", alone.alias("component_id"))
