"""Near-duplicate classes by ProbMinHash over word shingles, weighted and plain, with banding and exact checks.

1. Sketch. A document's shingles are its 5-word windows (a text of 1 to 4 words is one shingle);
   a shingle's weight is 1 + ln(occurrences). Every shingle is the source of a Poisson process
   with its weight as rate; each arrival falls on one of ``REGISTERS`` registers, and a register
   keeps the shingle of its first arrival. Arrivals later than the latest first arrival so far
   cannot matter, so a shingle's process stops there. Registers of two documents agree with the
   probability Jaccard of their weighted shingle sets. The same process at weight 1 gives the plain
   sketch, whose registers agree with the plain Jaccard, which step 3 decides on.
2. Banding. ``BANDS`` bands of ``ROWS`` registers of either sketch; documents that agree on a band are
   candidates. At a plain Jaccard of 0.8 a pair shares no band of the plain sketches with probability
   (1 - 0.8**4)**32 < 1e-7, however often either text repeats a shingle. Both sketches use one set of
   buckets: they are equal unless a text repeats a shingle, and equal bands are one row.
3. Verification. Inside a band's bucket every member is compared with the bucket's smallest
   member; a link needs a plain Jaccard of the two shingle sets of at least ``SIMILARITY``.
   Crowded buckets that still hold several classes are then gone through with other members in the
   middle. Buckets whose members do not all end in one class by that are gone through again in blocks
   of members: of members in different classes, pairs that can still be links (triangle
   inequality on the distances to the smallest member, at least ``AGREEING`` equal plain registers) are
   compared too. So dense groups cost one comparison per member, and no link is given up.
4. Classes are the connected components of the links (alternating large-star, small-star).

Equal texts share one representative before step 2, so copies cost one narrow row each.

Defined results: one row per input row; ``class_id`` is the smallest doc_id of the class (null if
it has none), ``class_size`` its number of rows. Texts that are null or have no word are linked to
equal texts only. Repeated doc_ids are rows of their own. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm import common as C

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS, BANDS, ROWS = 128, 32, 4
#: Equal registers of the plain sketches (of 128) a pair needs before it is verified in step 3's second part.
#: They are independent and agree with the plain Jaccard each, so at 0.8 or more fewer than 64 agree with
#: probability under exp(-128 KL(0.5 | 0.8)) = 0.8**128 < 1e-12.
AGREEING = 64
BLOCK = 512
#: Buckets from this size on get more stars before pairs, in at most so many rounds.
CROWD, ROUNDS = 16, 8


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and their rows, in text order, repeats included."""
    starts, ends, rows = C.spans_of_words(data, offsets)
    words = C.span_hash(C.prefix_sums(data), starts, ends)
    hashes, first = C.window_hash(words, rows, SHINGLE)
    out, at = [hashes], [rows[first]]
    count = np.bincount(rows, minlength=len(offsets) - 1)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    head = np.searchsorted(rows, short)
    for k in range(1, SHINGLE):
        own = count[short] == k
        if own.any():
            mixed = np.full(int(own.sum()), k, np.uint64)
            for i in range(k):
                mixed = mixed * np.uint64(0xD1342543DE82EF95) + words[head[own] + i]
            out.append(C.mix64(mixed))
            at.append(short[own])
    hashes, at = np.concatenate(out), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return hashes[order], at[order]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every row: rows (ascending), hashes (ascending within a row), occurrences."""
    hashes, rows = shingles(data, offsets)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    head = np.ones(len(rows), bool)
    head[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(head)
    return rows[at], hashes[at], np.diff(np.append(at, len(rows)))


def probminhash(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """Signature matrix (rows x registers) of weighted sets; all zero for an empty set."""
    arrival = np.full(n_rows * registers, np.inf)
    winner = np.zeros(n_rows * registers, np.uint64)
    live = np.arange(len(rows))
    clock = np.zeros(len(rows))
    step, burst = 0, 1
    while len(live):
        for _ in range(burst):
            draw = C.mix64(hashes[live] + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            unit = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
            clock[live] -= np.log(unit) / weights[live]
            slot = rows[live] * registers + (C.mix64(draw + np.uint64(0x632BE59BD9B4E019)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(arrival, slot, clock[live])
            won = clock[live] == arrival[slot]
            winner[slot[won]] = hashes[live][won]
            step += 1
        latest = arrival.reshape(n_rows, registers).max(axis=1)
        live = live[clock[live] < latest[rows[live]]]
        burst = min(burst * 2, 16)
    return winner.reshape(n_rows, registers)


def _sketch(batches):
    C.no_worker_state()
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part, data, offsets in C.byte_slices(batch, "text"):
            n = len(offsets) - 1
            rows, hashes, count = shingle_sets(data, offsets)
            signature = probminhash(rows, hashes, np.ones(len(rows)), n)
            worded = np.bincount(rows, minlength=n) > 0
            low = (signature & np.uint64(0xFFFFFFFF)).astype("<u4")
            # The weighted sketch differs from the plain one in texts that repeat a shingle only.
            repeats = np.bincount(rows, weights=count > 1, minlength=n) > 0
            own = repeats[rows]
            weighted = probminhash((np.cumsum(repeats) - 1)[rows[own]], hashes[own], 1.0 + np.log(count[own]), int(repeats.sum()))
            heavy = iter((weighted & np.uint64(0xFFFFFFFF)).astype("<u4"))
            body = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("same"),
                 pa.array(worded), pa.array(np.bincount(rows, minlength=n)), pa.array([row.tobytes() for row in low], pa.binary()),
                 pa.array([next(heavy).tobytes() if r else None for r in repeats], pa.binary()),
                 pa.array([squeeze.compress(body[offsets[i]:offsets[i + 1]]) for i in range(n)], pa.binary())],
                names=["doc_id", "same", "worded", "size", "signature", "weighted", "body"])


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per row and band; its last bits are the band."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = C.mix64(key + parts[:, :, i] * np.uint64(0xE7037ED1A0B428DB))
    return key & ~np.uint64(BANDS - 1) | np.arange(BANDS, dtype=np.uint64)


def bucket_rows(signature: list[bytes], weighted: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bucket keys of every row, from its plain and (if it differs) its weighted signature, and their rows."""
    read = lambda rows: np.frombuffer(b"".join(rows), "<u4").reshape(len(rows), REGISTERS)
    keys = band_keys(read(signature))
    heavy = np.array([i for i, w in enumerate(weighted) if w is not None], np.int64)
    more = band_keys(read([weighted[i] for i in heavy]))
    row, band = np.nonzero(more != keys[heavy])
    return np.concatenate([keys.ravel(), more[row, band]]), np.concatenate([np.repeat(np.arange(len(keys)), BANDS), heavy[row]])


def _bands(batches):
    for batch in batches:
        if batch.num_rows:
            keys, rows = bucket_rows(batch.column("signature").to_pylist(), batch.column("weighted").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(batch.column("rid").to_numpy()[rows])], names=["bucket", "rid"])


def jaccard_of(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Jaccard of the shingle sets of text pairs (UTF-8)."""
    n = len(left)
    both = left + right
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in both]))).astype(np.int64)
    rows, hashes, _ = shingle_sets(np.frombuffer(b"".join(both), np.uint8), offsets)
    size = np.bincount(rows, minlength=2 * n)
    key = C.mix64(hashes + (rows % max(n, 1)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key.sort()
    common = key[1:][key[1:] == key[:-1]]
    # Which pair an intersection entry belongs to is recovered through its left-hand row.
    mine = rows < n
    left_key = C.mix64(hashes[mine] + rows[mine].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    shared = np.bincount(rows[mine][np.isin(left_key, common)], minlength=n)
    return shared / np.maximum(size[:n] + size[n:] - shared, 1)


def _verify(batches):
    loosen = zstandard.ZstdDecompressor()
    for batch in batches:
        left, right, size, done = [], [], 0, 0
        sides = [batch.column(c).to_pylist() for c in ("body_a", "body_b")]
        for i in range(batch.num_rows):
            left.append(loosen.decompress(sides[0][i]))
            right.append(loosen.decompress(sides[1][i]))
            size += len(left[-1]) + len(right[-1])
            if size >= C.SLICE_BYTES or i == batch.num_rows - 1:
                part = batch.slice(done, len(left))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(jaccard_of(left, right))],
                                                 names=["a", "b", "jaccard"])
                left, right, size, done = [], [], 0, i + 1


def verify(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Exact similarity of each (a, b); ``bodies`` has (rid, body) of the candidates.

    Pairs and candidates both grow with the data, so the joins are shuffles at every size.
    """
    return (pairs.hint("merge").join(bodies.select(F.col("rid").alias("a"), F.col("body").alias("body_a")), "a")
            .hint("merge").join(bodies.select(F.col("rid").alias("b"), F.col("body").alias("body_b")), "b")
            .select("a", "b", "body_a", "body_b").mapInArrow(_verify, "a bigint, b bigint, jaccard double"))


def components(links: DataFrame) -> DataFrame:
    """(rid, comp) for every rid in ``links`` (a, b): comp is the smallest rid it is connected to.

    Large-star and small-star steps in turn until the links are a star per component; every step
    is written to the shared folder.
    """
    edges = C.materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    while True:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (sides.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(floor, "a").select(F.col("b").alias("v"), "m").unionByName(floor.select(F.col("a").alias("v"), "m"))
                 .filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        after = C.materialize(small, "links")
        changed = after.exceptAll(edges).limit(1).count() + edges.exceptAll(after).limit(1).count()
        edges = after
        if not changed:
            return (edges.select(F.col("a").alias("rid"), F.col("b").alias("comp"))
                    .unionByName(edges.select(F.col("b").alias("rid"), F.col("b").alias("comp")).distinct()))


def _prefixes_meet(left: list[dict], right: list[dict]) -> np.ndarray:
    """Which pairs can have the similarity by prefix filtering.

    With shingles in one order for all (rarest first), an overlap of o makes the first
    size - o + 1 shingles of both sets share one. ``prefix`` holds the shingles that can matter,
    ``alone`` how many come before them that no other document has.
    """
    size = [np.array([m["size"] for m in side]) for side in (left, right)]
    overlap = np.ceil(SIMILARITY / (1 + SIMILARITY) * (size[0][:, None] + size[1][None, :]) - 1e-9).astype(np.int64)
    room = [size[0][:, None] - overlap, size[1][None, :] - overlap]
    entries = []
    for side in (left, right):
        n = [len(m["prefix"]) for m in side]
        token = np.fromiter((t for m in side for t in m["prefix"]), np.int64, sum(n))
        member = np.repeat(np.arange(len(side)), n)
        place = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n) + np.repeat([m["alone"] for m in side], n)
        order = np.argsort(token, kind="stable")
        entries.append((token[order], member[order], place[order].astype(np.int64)))
    out = np.zeros(overlap.shape, bool)
    for token in np.intersect1d(entries[0][0], entries[1][0]):
        (i, at_i), (j, at_j) = ((m[slice(*np.searchsorted(t, [token, token + 1]))], p[slice(*np.searchsorted(t, [token, token + 1]))]) for t, m, p in entries)
        cell = np.ix_(i, j)
        out[cell] |= (at_i[:, None] <= room[0][cell]) & (at_j[None, :] <= room[1][cell])
    return out


def _block_pairs(batches):
    """Pairs of one block pair whose members are in different classes and may still be links."""
    for batch in batches:
        out_a, out_b = [], []
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            left, right = row["left"], row["right"]
            read = lambda side, f: np.array([m[f] for m in side])
            la, ra = (np.frombuffer(b"".join(m["signature"] for m in s), "<u4").reshape(len(s), REGISTERS) for s in (left, right))
            band = row["bucket"] & (BANDS - 1)
            agree = np.zeros((len(left), len(right)), np.int16)
            fresh = np.ones(agree.shape, bool)  # not met in an earlier band of the plain sketches
            for k in range(BANDS):
                equal = np.zeros_like(agree)
                for r in range(k * ROWS, (k + 1) * ROWS):
                    equal += la[:, r, None] == ra[None, :, r]
                agree += equal
                if k < band:
                    fresh &= equal < ROWS
            near = np.abs(read(left, "j")[:, None] - read(right, "j")[None, :]) <= 1 - SIMILARITY + 1e-9
            room = _prefixes_meet(left, right)
            other = read(left, "comp")[:, None] != read(right, "comp")[None, :]
            a, b = np.nonzero((agree >= AGREEING) & fresh & near & room & other)
            out_a.append(read(left, "rid")[a])
            out_b.append(read(right, "rid")[b])
        if out_a:
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b), pa.int64()), pa.array(np.minimum(a, b), pa.int64())], names=["a", "b"])


def _shingle_rows(batches):
    loosen = zstandard.ZstdDecompressor()
    for batch in batches:
        for rid, body in zip(batch.column("rid").to_pylist(), batch.column("body").to_pylist()):
            data = loosen.decompress(body)
            _, hashes, _ = shingle_sets(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), rid)), pa.array(hashes.view(np.int64))], names=["rid", "shingle"])


def mixed_members(members: DataFrame, comp: DataFrame, least: int = 3) -> DataFrame:
    """Members but the smallest of the buckets that hold two classes: (bucket, rid, leader, comp, n); written."""
    tagged = members.join(comp, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    mixed = C.materialize(tagged.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
                          .filter((F.col("lo") != F.col("hi")) & (F.col("n") >= least)).select("bucket", "n"), "mixed")
    return C.materialize(tagged.filter("rid <> leader").join(mixed, "bucket"), "far")


def more_stars(members: DataFrame, checked: DataFrame, comp: DataFrame, round_: int) -> DataFrame:
    """One more member of each large mixed bucket against the bucket's members of other classes: pairs not yet checked."""
    far = mixed_members(members, comp, CROWD)
    pick = C.materialize(far.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("bucket", "rid", F.lit(round_)).alias("h"), F.col("rid").alias("hub"),
                                                                  F.col("comp").alias("hub_comp"))).alias("s"))
                         .select("bucket", "s.hub", "s.hub_comp"), "hubs")
    pairs = far.join(pick, "bucket").filter("comp <> hub_comp").select(F.greatest("rid", "hub").alias("a"), F.least("rid", "hub").alias("b")).distinct()
    return pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")


def unresolved_pairs(members: DataFrame, stars: DataFrame, checked: DataFrame, comp: DataFrame, heads: DataFrame) -> DataFrame:
    """Last part of step 3: candidate pairs across classes inside a bucket, compared in blocks.

    ``members`` is (bucket, rid, leader), ``stars`` the similarities to the leaders. Only buckets
    that hold two classes are looked at.
    """
    far = mixed_members(members, comp).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    # Shingles of these documents, rarest first. One that no other of them has cannot be in an overlap.
    open_ = far.select("rid").distinct()
    rows = C.materialize(heads.select("rid", "body").join(open_, "rid", "left_semi").mapInArrow(_shingle_rows, "rid bigint, shingle bigint"), "shingles")
    known = C.materialize(rows.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    listed = rows.join(known, "shingle").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("list"))
    alone = F.col("size") - F.size("list")
    reach = F.col("size") - F.ceil(F.col("size") * SIMILARITY - 1e-9) + 1 - alone  # of the list, what a prefix can hold
    facts = C.materialize(heads.select("rid", "signature", "size").join(listed, "rid").filter(reach > 0)
                          .select("rid", "signature", "size", alone.alias("alone"), F.transform(F.slice("list", F.lit(1), reach.cast("int")), lambda x: x["shingle"]).alias("prefix")), "facts")
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    packed = (far.join(stars.select(F.col("a").alias("rid"), F.col("b").alias("leader"), F.col("jaccard").alias("j")), ["rid", "leader"])
              .join(facts, "rid").withColumn("block", block).groupBy("bucket", "block", "blocks")
              .agg(F.collect_list(F.struct("rid", "comp", "j", "size", "alone", "prefix", "signature")).alias("side")))  # about BLOCK members
    left = packed.select("bucket", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("other"), F.col("side").alias("left"))
    right = packed.select("bucket", F.col("block").alias("other"), F.col("side").alias("right"))
    return (left.join(right, ["bucket", "other"]).select("bucket", "left", "right").mapInArrow(_block_pairs, "a bigint, b bigint")
            .distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti"))


def _sketched(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return C.with_row_key(rows.withColumn("same", F.unhex(F.sha2("text", 256)))
                          .mapInArrow(_sketch, "doc_id bigint, same binary, worded boolean, size bigint, signature binary, weighted binary, body binary"))


def _classes(sketch: DataFrame) -> DataFrame:
    """(same, rid, copies, least, comp) for every distinct text of the sketches."""
    spark = sketch.sparkSession
    copies = C.materialize(sketch.groupBy("same").agg(F.min("_uid").alias("rid"), F.count("*").alias("copies"),
                                                      F.min("doc_id").alias("least")), "copies")
    own = lambda rids: sketch.withColumnRenamed("_uid", "rid").join(rids.hint("merge"), "rid", "left_semi")

    bands = C.materialize(own(copies.select("rid")).filter("worded").select("rid", "signature", "weighted").mapInArrow(_bands, "bucket bigint, rid bigint"), "bands")
    leaders = C.materialize(bands.groupBy("bucket").agg(F.min("rid").alias("leader"), F.count("*").alias("n")).filter("n > 1").drop("n"), "leaders")
    members = C.materialize(bands.join(leaders, "bucket"), "members")
    C.discard(spark, bands, leaders)
    # Texts and signatures of the candidates alone: later steps read nothing else.
    heads = C.materialize(own(members.select("rid").distinct()).select("rid", "body", "size", "signature"), "heads")
    stars = members.filter("rid <> leader").select(F.col("rid").alias("a"), F.col("leader").alias("b")).distinct()
    bodies = heads.select("rid", "body")
    stars = C.materialize(verify(stars, bodies), "checked")
    checked, links = stars, stars.filter(F.col("jaccard") >= SIMILARITY).select("a", "b")
    found = C.materialize(components(links), "classes")

    def look(pairs: DataFrame) -> tuple[int, int]:
        """Verify more pairs; how many there were and how many are links."""
        nonlocal checked, links
        new = C.materialize(verify(C.materialize(pairs, "pairs"), bodies), "checked")
        more = new.filter(F.col("jaccard") >= SIMILARITY).select("a", "b")
        checked, links = checked.unionByName(new), links.unionByName(more)
        return new.count(), more.count()

    # Crowded buckets first get more stars as long as these are productive: each costs one pair per
    # member, and what they join need not be compared pair by pair below.
    for round_ in range(ROUNDS):
        n, joined = look(more_stars(members, checked, found, round_))
        if joined:
            found = C.materialize(components(links), "classes")
        if joined * 20 < n or not n:
            break
    if look(unresolved_pairs(members, stars, checked, found, heads))[1]:
        found = C.materialize(components(links), "classes")
    C.discard(spark, members)
    return copies.join(found, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size) for every row of ``docs`` (doc_id, text)."""
    sketch = _sketched(docs)
    classed = _classes(sketch)
    classes = classed.groupBy("comp").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    named = classed.select("same", "comp").join(classes, "comp").select("same", "class_id", "class_size")
    return sketch.select("doc_id", "same").join(named, "same").select("doc_id", "class_id", "class_size")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their class: one row each, with the smallest doc_id (then the smallest row key)."""
    key = C.free_name(docs, "_row")
    keyed = C.with_row_key(docs, key)
    sketch = _sketched(keyed.select(F.col(key).alias("doc_id"), "text"))
    ranked = keyed.select(F.col(key).alias("_row"), F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).alias("_id"))
    classed = _classes(sketch).select("same", "comp")
    members = sketch.select(F.col("doc_id").alias("_row"), "same").join(classed, "same").join(ranked, "_row").select("_row", "_id", "comp")
    low = members.groupBy("comp").agg(F.min("_id").alias("_id"))
    chosen = members.join(low, ["comp", "_id"]).groupBy("comp").agg(F.min("_row").alias(key)).select(key)
    return keyed.join(chosen, key, "left_semi").drop(key)
