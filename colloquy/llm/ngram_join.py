"""N-gram Jaccard join by grouped prefixes, with connected components of the links.

Equal sets are one node. Tokens have one order for all: rising by how frequent they are, as a bounded table of the most
frequent ones tells, then by hash; two sets can link only if their prefixes in this order share a token. Nodes with
identical prefix and size are one group; group pairs come from lists of the groups that hold a token in their prefix, and
are expanded to their members. A large set of near copies never becomes all its pairs:

- Each list has a pivot group. Members of the other groups are held against the pivot's lead, which gives links and, for
  those that share much of what they have with it, their difference from it. Jaccard distance is a metric, so a link
  between two members of a list has both of them near the pivot, or neither close to it. The latter stay in the list for
  a further round with another pivot; what then remains is paired (size and position filters) and verified.
- What is near one pivot is a family. Its centre is the majority vote over its members' tokens. Sets whose differences
  from the centre are small enough together must link, so the member closest to the centre takes in all of these at once;
  any other pair must share a stated number of differing tokens, which a prefix join over the differences, rarest first,
  finds and their intersection decides.

Pairs that are left out lie within one component and cannot change the result.

Defined results: null, empty or blank text has an empty set and is its own component; rows that repeat an id or a text
are nodes by their sets; ties go to the smallest id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .shared import Roller, Scratch, arrow_bytes, give_back, mix, texts, word_hashes, word_spans

#: 64-bit words of a parity bitmap, which bounds what two sets can share.
BITMAP = 16
#: The table of frequent tokens: least count, and entries at most (9 bytes each, sent to all executors). Tokens beyond it
#: count as rare, which costs time and changes no result.
FREQUENT, FREQUENT_ENTRIES = 12, 500_000
#: Bits of the filter that keeps most unneeded texts from being cut into shingles again; an exact join follows it.
FILTER_BITS = 23
#: Rounds of pivots before what remains of the lists is paired, and rows of one key after which it is dealt out further.
ROUNDS, HOT = 2, 2_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GRAM = Roller(0xB5026F5AA96619E9)


def shingle_sets(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, tokens): the distinct shingles of row i, sorted, are tokens[first[i] : first[i + 1]]."""
    raw, offsets = arrow_bytes(column)
    raw = _LOWER[raw]
    start, end, first = word_spans(raw, offsets)
    words = word_hashes(raw, start, end)
    count = np.diff(first)
    grams = np.where(count == 0, 0, np.maximum(count - size + 1, 1))
    row = np.repeat(np.arange(len(count)), grams)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
    to = np.minimum(at + size, first[row + 1])
    tokens = mix(_GRAM.of(_GRAM.prefix(words), at, to) + (to - at).astype(np.uint64), 0x2545F4914F6CDD1D)
    order = np.lexsort((tokens, row))
    row, tokens = row[order], tokens[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (tokens[1:] != tokens[:-1])
    row, tokens = row[fresh], tokens[fresh]
    return np.searchsorted(row, np.arange(len(count) + 1)), tokens


def _batches(batches: Iterator, rows: int = 400, size: int = 250_000) -> Iterator:
    """Slices of few rows and about ``size`` bytes of text, so that memory depends on neither batch nor text lengths."""
    import pyarrow.compute as pc

    for whole in batches:
        upto = np.cumsum(pc.binary_length(whole.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(whole):
            full = int(np.searchsorted(upto, size + (upto[at - 1] if at else 0), "right"))
            to = min(max(full, at + 1), at + rows, len(whole))
            yield whole.slice(at, to - at)
            at = to
    give_back()


def _sum_by_row(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[first[1:]] - total[first[:-1]]


def _counted(size: int, parts: int):
    """All tokens, by their first ``parts`` bits, the rest of 40 packed in 32-bit values."""
    low = np.uint64(40 - parts)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, n = [], 0

        def flush():
            ids = np.sort(np.concatenate(held))
            part = (ids >> low).astype(np.int64)
            head = np.flatnonzero(np.diff(part, prepend=-1))
            rest = (ids & ((np.uint64(1) << low) - np.uint64(1))).astype(np.uint32)
            blobs = [x.tobytes() for x in np.split(rest, head[1:])]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(part[head].astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "blob"])

        for batch in _batches(batches):
            _, tokens = shingle_sets(batch.column("text"), size)
            held.append(tokens >> np.uint64(24))
            n += len(tokens)
            if n > 500_000:
                yield flush()
                n = 0
        if n:
            yield flush()

    return run


def _totals(parts: int):
    """Counts of the frequent tokens; rows come sorted by part, so one part is held at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def count(part, held):
            ids, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= FREQUENT
            return pa.RecordBatch.from_arrays([pa.array(ids[often].astype(np.int64) | part << (40 - parts)), pa.array(n[often].astype(np.int64))], ["token", "n"])

        own, held = None, []
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob"), strict=True):
                if part != own and held:
                    yield count(own, held)
                    held = []
                own = part
                held.append(np.frombuffer(blob.as_buffer(), np.uint32))
        if held:
            yield count(own, held)

    return run


def frequent_tokens(body: DataFrame, size: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens (their first 40 bits), sorted, and the logarithms of their counts; as many levels of
    counts as the table takes. Tokens are counted in so many parts that one holds about two million, whatever the input.
    """
    total = (body.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 5
    parts = min(max(8, int(total // 2_000_000).bit_length()), 30)
    counted = body.select("text").mapInArrow(_counted(size, parts), "part int, blob binary").repartition("part").sortWithinPartitions("part")
    table = scratch.written(counted.mapInArrow(_totals(parts), "token long, n long"), "frequent")
    levels = sorted(((r["n"], r["c"]) for r in table.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("c")).collect()), reverse=True)
    total, least = 0, None
    for n, c in levels:
        total += c
        if total > FREQUENT_ENTRIES:
            break
        least = n
    if least is None:
        scratch.drop(table)
        return np.zeros(0, np.uint64), np.zeros(0, np.int8)
    got = table.where(F.col("n") >= least).select("token", F.log2("n").cast("tinyint").alias("level")).toArrow()
    token, level = got.column(0).to_numpy().astype(np.uint64), got.column(1).to_numpy()
    order = np.argsort(token)
    scratch.drop(table)
    return token[order], level[order]


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def _signed(size: int, percent: int, frequent):
    """For each row its keys, the size of its set and two sums that tell it, and its prefix in the common order; gid tells
    prefix and size."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hot, level = frequent.value
        for batch in _batches(batches):
            first, tokens = shingle_sets(batch.column("text"), size)
            n = np.diff(first)
            one, two = (_sum_by_row(first, mix(tokens, s)).view(np.int64) for s in (0x1F83D9AB, 0x5BE0CD19))
            row = np.repeat(np.arange(len(n)), n)
            late = np.zeros(len(tokens), np.int8)
            if len(hot):
                ids = tokens >> np.uint64(24)
                at = np.minimum(np.searchsorted(hot, ids), len(hot) - 1)
                late = np.where(hot[at] == ids, level[at], late)
            order = np.lexsort((tokens, late, row))
            place = np.arange(len(row)) - first[row]
            own = order[place < prefix_length(n, percent)[row]]
            head = np.concatenate([[0], np.cumsum(np.minimum(prefix_length(n, percent), n))])
            group = _sum_by_row(head, mix(tokens[own], 0x3C6EF372)) ^ mix(n.astype(np.uint64), 0xA54FF53A)
            lists = pa.ListArray.from_arrays(pa.array(head.astype(np.int32)), pa.array(tokens[own].view(np.int64)))
            bit = (tokens >> np.uint64(8)) & np.uint64(64 * BITMAP - 1)
            odd = np.bincount(row * 64 * BITMAP + bit.astype(np.int64), minlength=len(n) * 64 * BITMAP).astype(np.uint8) & 1
            words = np.packbits(odd.reshape(-1, 64), axis=1, bitorder="little").reshape(-1).view("<i8")
            parity = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BITMAP), pa.array(words))
            columns = [batch.column(c) for c in ("doc_id", "k1", "k2")] + [pa.array(n), pa.array(one), pa.array(two), pa.array(group.view(np.int64)), lists, parity]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k1", "k2", "n", "f1", "f2", "gid", "tokens", "bits"])

    return run


def _sets(size: int, wanted):
    """Whole sets of the rows whose keys the filter lets pass, each key once in a task."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits, seen = wanted.value, set()

        def likely(whole):
            k1, k2 = whole.column("k1").to_numpy(), whole.column("k2").to_numpy()
            slot = k1 & ((1 << FILTER_BITS) - 1)
            passed = (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
            for i in np.flatnonzero(passed).tolist():
                key = (k1[i], k2[i])
                passed[i] = key not in seen
                seen.add(key)
            return whole.filter(pa.array(passed))

        for batch in _batches(map(likely, batches)):
            first, tokens = shingle_sets(batch.column("text"), size)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(tokens.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), lists], ["k1", "k2", "tokens"])

    return run


def dealt(many: DataFrame, one: DataFrame, key: str, by: str) -> DataFrame:
    """many joined with one, which has a row for each key. Keys with many rows are dealt out by the column ``by``, and
    their row in ``one`` repeated as often; ``way`` tells the share."""
    hot = many.groupBy(key).agg(F.count("*").alias("c")).where(F.col("c") > HOT).select(key, F.ceil(F.col("c") / HOT).cast("int").alias("ways"))
    ways = F.coalesce("ways", F.lit(1))
    many = many.join(hot, key, "left").withColumn("way", F.pmod(F.hash(by), ways)).drop("ways")
    one = one.join(hot, key, "left").withColumn("way", F.explode(F.sequence(F.lit(0), ways - 1))).drop("ways")
    return many.join(one, [key, "way"])


class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int):
        self.size, self.percent, self.both = size, percent, 100 + percent
        self.half = max(10, 2 * percent - 110)  # what is near a pivot; what is close lies between this and a link
        self.scratch = Scratch(docs.sparkSession)
        self.written, self.drop = self.scratch.written, self.scratch.drop
        body = texts(docs, id_col, text_col)
        self.body = body.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2"))
        kind = body.schema["doc_id"].dataType.simpleString()
        frequent = docs.sparkSession.sparkContext.broadcast(frequent_tokens(body, size, self.scratch))
        signed = self.body.select("doc_id", "k1", "k2", "text").mapInArrow(
            _signed(size, percent, frequent), f"doc_id {kind}, k1 long, k2 int, n long, f1 long, f2 long, gid long, tokens array<long>, bits array<long>"
        )
        signed = self.written(signed, "signed")
        frequent.destroy()  # what it served is written
        self.scratch.release()
        self.rows = self.written(signed.drop("gid", "tokens", "bits"), "rows")
        one = F.min(F.struct("k1", "k2", "gid", "tokens", "bits")).alias("one")
        nodes = signed.where("n > 0").groupBy("n", "f1", "f2").agg(one).select(F.monotonically_increasing_id().alias("node"), "n", "f1", "f2", "one.*")
        self.nodes = self.written(nodes, "nodes")
        self.drop(signed)
        self.scratch.release()

    def near(self, pairs: DataFrame) -> DataFrame:
        """(x, p, nx, np, extra, delta) of the pairs (x, p) whose similarity is ``half`` or more; delta holds the
        ``extra`` tokens that only x has (odd) and those that only p has (even)."""
        # Sets that differ in d places of their bitmaps differ in d tokens at least.
        side = lambda x, k: self.nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"b{k}"))
        apart = F.aggregate(F.zip_with("b1", "b2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        most = F.least("nx", "np", (F.col("nx") + F.col("np") - apart) / 2)
        likely = dealt(pairs.join(side("x", 1), "x"), side("p", 2), "p", "x").where((100 + self.half) * most >= self.half * (F.col("nx") + F.col("np"))).select("x", "p", "way", "nx", "np")
        likely = self.written(likely, "likely")
        # Each set goes once to the pairs that it is part of, the one of p with a mark; then all meet by p.
        itself = likely.select(F.col("p").alias("x"), "p", "way", F.col("np").alias("nx"), "np").distinct()
        keyed = self.written(likely.unionByName(itself).join(self.nodes.select(F.col("node").alias("x"), "k1", "k2"), "x"), "keyed")
        bits = np.zeros(1 << FILTER_BITS, np.uint8)
        bits[keyed.select(F.col("k1").bitwiseAND((1 << FILTER_BITS) - 1).cast("int").alias("slot")).distinct().toArrow().column(0).to_numpy()] = 1
        self.scratch.release()
        wanted = self.nodes.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))
        sets = self.body.select("k1", "k2", "text").mapInArrow(_sets(self.size, wanted), "k1 long, k2 int, tokens array<long>")
        rows = keyed.join(sets, ["k1", "k2"])
        whole = Window.partitionBy("p", "way").orderBy(F.col("x") != F.col("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.select("x", "p", "nx", "np", "tokens", F.first("tokens").over(whole).alias("of_p")).where("x <> p")
        # In the JVM, pair by pair: Arrow batches of pairs of whole sets would take much memory on both sides.
        rows = rows.withColumn("only", F.array_except("tokens", "of_p")).where((100 + self.half) * (F.col("nx") - F.size("only")) >= self.half * (F.col("nx") + F.col("np")))
        delta = F.concat(F.transform("only", lambda t: F.shiftleft(t, 1).bitwiseOR(F.lit(1))), F.transform(F.array_except("of_p", "tokens"), lambda t: F.shiftleft(t, 1)))
        found = self.written(rows.select("x", "p", "nx", "np", F.size("only").alias("extra"), delta.alias("delta")), "near")
        wanted.destroy()
        self.drop(likely, keyed)
        self.scratch.release()
        return found

    def linking(self, same: Column, n1: str = "nx", n2: str = "np") -> Column:
        return self.both * same >= self.percent * (F.col(n1) + F.col(n2))

    def close(self) -> Column:
        """Whether x shares so much with p that it cannot link with what is not near p."""
        same = F.col("nx") - F.col("extra")
        return 100 * same >= (100 + self.half - self.percent) * (F.col("nx") + F.col("np") - same)

    def links(self) -> DataFrame:
        """(a, b) of nodes: links, as many as the components need."""
        leads = self.nodes.groupBy("gid").agg(F.min("node").alias("p"))
        lead = self.written(leads, "leads")
        inside = self.nodes.select("gid", F.col("node").alias("x")).join(lead, "gid").where("x <> p")
        inside = self.written(inside.withColumn("pivot", F.col("gid")), "inside")
        self.members = self.nodes.select("node", "gid", "n")
        entries, families = self.lists(lead), []
        for k in range(ROUNDS):
            # gid is a hash, so the least of a list is a pivot chosen at random, and the same one for lists with much in common
            pivots = entries.groupBy("token").agg(F.min("gid").alias("pivot"))
            entries = self.step(entries, self.written(entries.join(pivots, "token").where("gid <> pivot"), "entries"))
            groups = entries.select("gid", "pivot").distinct()
            pairs = groups.join(self.members.select("gid", F.col("node").alias("x")), "gid").join(lead.select(F.col("gid").alias("pivot"), "p"), "pivot")
            pairs = pairs.select("gid", "pivot", "x", "p")
            pairs = self.written(pairs.unionByName(inside) if k == 0 else pairs, "pairs")
            found = self.near(pairs.select("x", "p"))
            families.append(found)
            far = pairs.join(found.where(self.close()).select("x", "p"), ["x", "p"], "left_anti")
            left = entries.join(far.select("gid", "pivot").distinct(), ["gid", "pivot"], "left_semi").drop("pivot")
            if k == 0:
                # Members of a group that are not close to its lead get groups of their own.
                alone = self.written(far.where("gid = pivot").select(F.col("x").alias("node"), F.xxhash64("x", "gid").alias("own")), "alone")
                self.members = self.written(self.members.join(alone, "node", "left").select("node", F.coalesce("own", "gid").alias("gid"), "n"), "members")
                posts = self.nodes.join(alone, "node").select(F.posexplode("tokens").alias("at", "token"), F.col("own").alias("gid"), "n")
                left = left.unionByName(posts.select("token", "gid", "n", "at"))
                lead = self.step(lead, self.written(lead.unionByName(alone.select(F.col("own").alias("gid"), F.col("node").alias("p"))), "leads"))
            lists = left.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
            entries = self.step(entries, self.written(left.join(lists, "token"), "entries"))
            self.drop(pairs)
            if k == 0:
                self.drop(alone, inside)
        near = families[0]
        for more in families[1:]:
            near = near.unionByName(more)
        near = self.written(near.dropDuplicates(["x", "p"]), "families")
        self.drop(*families)
        self.scratch.release()
        links = near.where(self.linking(F.col("nx") - F.col("extra"))).select(F.col("x").alias("a"), F.col("p").alias("b"))
        known = self.written(components(links, self.scratch), "known")
        self.place = lambda rows, x, c: rows.join(known.select(F.col("node").alias(x), F.col("component").alias(c)), x, "left").withColumn(c, F.coalesce(c, x))
        out = self.written(links.unionByName(self.in_families(near)).unionByName(self.rest(entries)), "links")
        self.drop(near, known, entries, lead, self.members)
        return out

    def step(self, before: DataFrame, after: DataFrame) -> DataFrame:
        self.drop(before)
        return after

    def lists(self, lead: DataFrame) -> DataFrame:
        """(token, gid, n, at): the groups that hold a token in their prefix, where there are several."""
        first = self.nodes.join(lead.select(F.col("p").alias("node")), "node", "left_semi")
        postings = first.select(F.posexplode("tokens").alias("at", "token"), "gid", "n")
        often = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
        out = self.written(postings.join(often, "token").select("token", "gid", "n", "at"), "lists")
        self.scratch.release()
        return out

    def in_families(self, near: DataFrame) -> DataFrame:
        """Links between members of a family that the links to pivots leave in several components."""
        heads = near.groupBy("p").agg(F.max("np").alias("np"))
        itself = heads.select(F.col("p").alias("x"), "p", F.col("np").alias("nx"), "np", F.array().cast("array<long>").alias("delta"))
        rows = self.place(near.select("x", "p", "nx", "np", "delta").unionByName(itself), "x", "cx")
        rows = self.written(rows, "placed")
        split = rows.groupBy("p").agg(F.count("*").alias("size"), F.min("cx").alias("c1"), F.max("cx").alias("c2")).where("c1 <> c2 AND size > 2").select("p", "size")  # a pair is decided already
        split = self.written(split, "split")
        family = self.written(rows.join(split.select("p"), "p", "left_semi"), "family")
        self.drop(rows)
        counts = self.written(family.select("p", F.explode("delta").alias("token")).groupBy("p", "token").agg(F.count("*").alias("c")).join(split, "p"), "counts")
        centre = counts.where(2 * F.col("c") > F.col("size")).groupBy("p").agg(F.collect_list("token").alias("m"))
        centre = split.join(centre, "p", "left").select("p", "size", F.coalesce("m", F.array().cast("array<long>")).alias("m"))
        odd = lambda a: F.size(F.filter(a, lambda t: t.bitwiseAND(F.lit(1)) == 1))
        even = lambda a: F.size(F.filter(a, lambda t: t.bitwiseAND(F.lit(1)) == 0))
        rows = dealt(family, centre, "p", "x").withColumns({"own": F.array_except("delta", "m"), "not": F.array_except("m", "delta")})
        lacks = even("own") + odd("not")
        rows = rows.select(
            "x", "p", "cx", "nx", (F.col("np") - even("m") + odd("m")).alias("centre"), (self.both * lacks + self.percent * F.col("nx")).alias("w"), F.concat("own", "not").alias("delta")
        )
        family2 = self.written(rows, "centred")
        self.drop(family)
        # Two members link when both * (centre + shared) >= w1 + w2, shared being what their differences have in common.
        best = family2.groupBy("p").agg(F.min(F.struct("w", "x")).alias("best"))
        rows = dealt(family2, best, "p", "x").withColumn("most", self.both * F.col("centre") - F.col("best.w"))  # what the best one surely links with
        rows = self.written(rows.select("x", "p", "cx", "centre", "w", "delta", F.col("best.x").alias("hub"), "most", (F.col("w") > F.col("most")).alias("outer")), "centred")
        self.drop(family2)
        sure = rows.where("NOT outer AND x <> hub").select(F.col("x").alias("a"), F.col("hub").alias("b"))
        # The least that a member must share: an outer one with any, an inner one with an outer one.
        partner = F.when(F.col("outer"), self.both * F.col("centre") - F.col("most")).otherwise(F.col("most") + 1)
        least = F.greatest(F.lit(1), F.ceil((F.col("w") + partner) / self.both) - F.col("centre"))
        tokens = rows.withColumn("least", least).where(F.size("delta") >= F.col("least")).select("x", "p", "cx", "centre", "w", "outer", "least", F.explode("delta").alias("token"))
        rank = F.when(2 * F.col("c") > F.col("size"), F.col("size") - F.col("c")).otherwise(F.col("c"))
        ranked = tokens.join(counts.select("p", "token", rank.alias("rank")), ["p", "token"])
        ordered = ranked.groupBy("x", "p", "cx", "centre", "w", "outer", "least").agg(F.array_sort(F.collect_list(F.struct("rank", "token"))).alias("d"))
        ordered = ordered.withColumn("len", F.size("d")).select("x", "p", "cx", "centre", "w", "outer", "len", F.posexplode(F.expr("slice(d, 1, len - least + 1)")).alias("i", "t"))
        posts = self.written(ordered.select("x", "p", "cx", "centre", "w", "outer", (F.col("len") - F.col("i")).alias("left"), "t.token"), "differences")
        self.drop(counts)
        y = posts.select("p", "token", F.col("x").alias("y"), F.col("cx").alias("cy"), F.col("w").alias("wy"), F.col("outer").alias("oy"), F.col("left").alias("ly"))
        need = F.ceil((F.col("w") + F.col("wy")) / self.both) - F.col("centre")
        fits = (F.col("cx") != F.col("cy")) & (~F.col("oy") | (F.col("x") < F.col("y"))) & (F.col("left") >= need) & (F.col("ly") >= need)
        pairs = self.written(posts.where("outer").join(y, ["p", "token"]).where(fits).select("p", "x", "y").distinct(), "candidates")
        side = lambda x, k: rows.select("p", F.col("x").alias(x), F.col("delta").alias(f"d{k}"), F.col("w").alias(f"w{k}"), F.col("centre").alias(f"m{k}"))
        shared = F.size(F.array_intersect("d1", "d2"))
        held = pairs.join(side("x", 1), ["p", "x"]).join(side("y", 2), ["p", "y"]).where(self.both * (F.col("m1") + shared) >= F.col("w1") + F.col("w2"))
        out = self.written(sure.unionByName(held.select(F.col("x").alias("a"), F.col("y").alias("b"))), "family-links")
        self.drop(rows, posts, pairs, split)
        self.scratch.release()
        return out

    def position_fits(self, i: str, n: str, other: str) -> Column:
        """Whether sets of n and other tokens can be similar if the first token that they share is at place i of the one of n."""
        return self.both * (F.col(n) - F.col(i)) >= self.percent * (F.col(n) + F.col(other))

    def rest(self, entries: DataFrame) -> DataFrame:
        """Links among what no pivot is near to. Similar sets have a first common token; only lists in which both may have
        it at their places give a pair (position filter)."""
        side = lambda k: entries.select("token", F.col("gid").alias(f"g{k}"), F.col("n").alias(f"n{k}"), F.col("at").alias(f"i{k}"))
        fits = self.position_fits("i1", "n1", "n2") & self.position_fits("i2", "n2", "n1") & (100 * F.least("n1", "n2") >= self.percent * F.greatest("n1", "n2"))
        groups = side(1).join(side(2), "token").where((F.col("g1") < F.col("g2")) & fits).select("g1", "g2").distinct()
        member = lambda k, x: self.place(self.members, "node", "c").select(F.col("gid").alias(f"g{k}"), F.col("node").alias(x), F.col("c").alias(f"c{k}"))
        pairs = self.written(groups.join(member(1, "x"), "g1").join(member(2, "p"), "g2").where("c1 <> c2").select("x", "p"), "pairs")
        found = self.near(pairs)
        self.drop(pairs)
        return found.where(self.linking(F.col("nx") - F.col("extra"))).select(F.col("x").alias("a"), F.col("p").alias("b"))


def _labelled(join: _Join) -> DataFrame:
    """(n, f1, f2, component_id, b1, b2): each distinct set with the smallest doc_id of its component and the key of the
    row that stays: the first by id and key, without an id only where no row has one."""
    links = join.links()
    found = join.written(components(links, join.scratch), "found")
    join.drop(links)
    best = F.min(F.struct(F.isnull("doc_id"), "doc_id", "k1", "k2"))
    own = join.rows.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("label"), best.alias("best"))
    nodes = join.nodes.select("node", "n", "f1", "f2").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(own, ["n", "f1", "f2"])
    least = nodes.groupBy("component").agg(F.min("label").alias("component_id"), F.min("best").alias("best"))
    out = join.written(nodes.drop("best").join(least, "component").select("n", "f1", "f2", "component_id", F.col("best.k1").alias("b1"), F.col("best.k2").alias("b2")), "labelled")
    join.drop(found, join.nodes)
    return out


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; two sets link when 100 * common >= percent * union."""
    join = _Join(docs, id_col, text_col, size, percent)
    out = join.rows.join(_labelled(join), ["n", "f1", "f2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id, and of several texts under this id that
    with the smallest hash; a row without an id only where none has one. Rows with an empty set all stay."""
    join = _Join(docs, id_col, text_col, size, percent)
    best = (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2"))
    judged = join.written(join.rows.join(_labelled(join), ["n", "f1", "f2"]).select("k1", "k2", best.alias("best")), "judged")
    keys = ["__k1", "__k2"]
    gone = judged.where("NOT best").select("k1", "k2").distinct().toDF(*keys)
    again = join.written(judged.where("best").groupBy("k1", "k2").agg(F.count("*").alias("c")).where("c > 1").select("k1", "k2").toDF(*keys), "again")
    key = (F.col(id_col), F.col(text_col).cast("string"))
    left = docs.withColumns({"__k1": F.xxhash64(*key), "__k2": F.hash(*key)}).join(gone, keys, "left_anti")
    if not again.isEmpty():  # rows that repeat id and text
        left = left.join(again, keys, "left_anti").unionByName(left.join(again, keys, "left_semi").dropDuplicates(keys))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
