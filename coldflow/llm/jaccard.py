"""N-gram Jaccard join (9): exact links and components by a token-group matrix.

A document's set holds the 64-bit hashes of its distinct five-word shingles
(the whole word sequence where there are fewer).  Two documents link when
100 * intersection >= 75 * union.

1. Documents with equal sets are one class (set id: a 64-bit sum hash and the
   set's size).  Everything below is on classes.
2. Classes that cannot link are ruled out exactly: with n shingles, at least
   r = ceil(0.75 n) must be in the partner.  Of the m smallest of each set
   (m about n / 2) at least ceil(r / 4) are then also among the partner's m
   smallest; ``shared_counts`` counts those that any other class holds.
3. Groups of similar classes: rounds of min-hash blocks, first inside each
   Arrow batch, then across the cluster on the group leaders that are left.
   Members of a group are *verified* links to its leader.  A hot block shrinks
   to its leaders before each shuffle.
4. Classes that have at least r tokens in other groups (again an exact
   necessary condition; most drop out) are partitioned into kin: the same
   most frequent token and about the same size.  The token-group matrix holds
   (token, kin), the kin's unions.  Of a query class's rarest tokens
   (floor(n / 4) + ceil(n / 16)) other kin that hold a partner must hold a
   number that follows from the sizes; kin that pass are opened, as are the
   class's own, in parts of about OPENED classes.  In a part only queries with
   r tokens in the part's union are compared with its members.
5. A kin of several parts is first linked inside them, dealt twice, then by
   two scouts of each component and kin; what is linked is one component from
   then on.  Of two components only the smaller one's classes ask: the bounds
   of step 4 hold in both directions.
6. A part returns a spanning forest of the links found in it, at most one row
   for each group in it.  Groups joined by links are merged; the component id
   is the smallest document id.

No step returns the pairs of a group, and no link between different groups is
lost, so components are exact (up to hash collisions, about 2^-64 per pair of
shingles).

Defined cases: null, empty and wordless texts have no set and link with
nothing (their component is their own id); rows that repeat an id are
documents of their own; further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coldflow.llm.shared import shared_counts, sliced
from coldflow.llm.text import LOWER, U, Words, blocks, column_bytes, mix, sequence_hashes
from coldflow.llm.workers import cache
from coldflow.session import stage_table

SHINGLE = 5
ROUNDS = 3
LEADERS = 64
OPENED = 256
BAND = float(np.log(4 / 3))
BROADCAST_ROWS = 1_000_000
_KEYS = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)]


def doc_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents of a block, their number per document, set id per document)."""
    w = Words(LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0])
    at, h = w.ngrams(SHINGLE)
    doc = np.repeat(np.arange(len(offsets) - 1), w.counts)[at]
    few = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    if len(few):
        whole = np.array([sequence_hashes(w.hash[w.offset[d] : w.offset[d + 1]], int(w.counts[d]))[0] for d in few], np.uint64)
        where = np.searchsorted(doc, few)
        h, doc = np.insert(h, where, whole), np.insert(doc, where, few)
    cut = np.searchsorted(doc, np.arange(len(offsets)))
    h = h.copy()
    for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        h[a:z].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    n = np.bincount(doc, minlength=len(offsets) - 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + U(0x5851F42D4C957F2D)), dtype=np.uint64)])
    upto = np.cumsum(n)
    ids = mix(total[upto] - total[upto - n] + n.astype(np.uint64) * U(0x9E3779B97F4A7C15)).view(np.int64)
    return h, n, ids


def required(n):
    """ceil(0.75 n): tokens that a partner must share."""
    return -(-3 * n // 4)


def _batch_sets(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = column_bytes(b.column("text"))
    parts = [doc_sets(data, offsets[i : j + 1]) for i, j in blocks(offsets)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, n, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, n, ids


def _signature_rows(batches):
    cache("jaccard")  # nothing of its own to keep: tables of other operators go
    for b in sliced(batches):
        _, n, ids = _batch_sets(b)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(ids, mask=n == 0)], ["doc_id", "n", "sid"])


def _half_sets(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The m smallest shingles of each distinct set of a batch, for ``shared_counts``."""
    h, n, ids = _batch_sets(b)
    known, first = np.unique(ids, return_index=True)
    first = first[n[first] > 0]
    start = np.cumsum(n) - n
    m = np.minimum(n, np.maximum((n + 1) // 2, n // 4 + 1))[first]
    of = np.repeat(np.arange(len(first)), m)
    at = np.arange(len(of)) - np.repeat(np.cumsum(m) - m, m) + start[first][of]
    return ids[first], ids[first], h[at], of


def _tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(all tokens, tokens per row) of the ``tokens`` column."""
    data, offsets = column_bytes(b.column("tokens"))
    return data[offsets[0] : offsets[-1]].view("<u8"), np.diff(offsets) // 8


def _set_rows(batches):
    """Sets of the class representatives: (sid, rep, n, tokens)."""
    for b in sliced(batches):
        h, n, ids = _batch_sets(b)
        wanted = np.flatnonzero(ids == b.column("sid").to_numpy()) if b.num_rows else np.zeros(0, np.int64)
        end = np.cumsum(n)
        tokens = [h[end[k] - n[k] : end[k]].astype("<u8").tobytes() for k in wanted]
        yield pa.RecordBatch.from_arrays([pa.array(ids[wanted]), b.column("doc_id").take(pa.array(wanted)), pa.array(n[wanted].astype(np.int64)), pa.array(tokens, pa.binary())], ["sid", "rep", "n", "tokens"])


def links_to(leader: np.ndarray, tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which of the rows (``tokens`` one after another, ``n`` each) link with the sorted set ``leader``."""
    at = np.minimum(np.searchsorted(leader, tokens), len(leader) - 1)
    hit = np.concatenate([[0], np.cumsum(leader[at] == tokens)])
    end = np.cumsum(n)
    both = hit[end] - hit[end - n]
    return 100 * both >= 75 * (len(leader) + n - both)


def cluster(sid: np.ndarray, rep: np.ndarray, tokens: np.ndarray, n: np.ndarray, key: np.ndarray, parent: np.ndarray) -> None:
    """Inside each block of equal keys, link rows that are still their own parent to leaders; updates ``parent`` (row numbers)."""
    live = np.flatnonzero(parent == np.arange(len(sid)))
    live = live[np.lexsort((sid[live], rep[live], key[live]))]
    if len(live) < 2:
        return
    end = np.cumsum(n)
    cut = np.flatnonzero(np.concatenate([[True], key[live][1:] != key[live][:-1]]))
    for a, z in zip(cut.tolist(), np.append(cut[1:], len(live)).tolist(), strict=True):
        rest = live[a:z]
        for _ in range(LEADERS):
            if len(rest) < 2:
                break
            lead, rest = rest[0], rest[1:]
            near = rest[(n[rest] * 4 >= 3 * n[lead]) & (n[lead] * 4 >= 3 * n[rest])]
            if not len(near):
                continue
            values = np.concatenate([tokens[end[k] - n[k] : end[k]] for k in near])
            linked = near[links_to(tokens[end[lead] - n[lead] : end[lead]], values, n[near])]
            parent[linked] = lead
            rest = rest[~np.isin(rest, linked)] if len(linked) else rest


_LINKED = "sid long, rep long, n long, keys array<long>, parent_sid long, parent_rep long"
_LINKS = "qg struct<rep: long, sid: long>, xg struct<rep: long, sid: long>"


def _cluster_rows(rounds: list[int], moved_only: bool):
    """Cluster each Arrow batch by the given min-hash keys; keys stay with the leaders only."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            tokens, n = _tokens(b)
            sid, rep = b.column("sid").to_numpy(), b.column("rep").to_numpy()
            begin = np.cumsum(n) - n
            keys = np.stack([np.minimum.reduceat(mix(tokens * k), begin) for k in _KEYS], axis=1).view(np.int64)
            parent = np.arange(len(sid))
            for r in rounds:
                cluster(sid, rep, tokens, n, keys[:, r], parent)
            lead = parent == np.arange(len(sid))
            out = pa.RecordBatch.from_arrays(
                [b.column("sid"), b.column("rep"), b.column("n"), pa.array([k.tolist() if x else None for k, x in zip(keys, lead, strict=True)], pa.list_(pa.int64())), pa.array(_root(sid, parent)), pa.array(_root(rep, parent))],
                ["sid", "rep", "n", "keys", "parent_sid", "parent_rep"],
            )
            yield out.filter(pa.array(~lead)) if moved_only else out

    return run


def _root(value: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The value at the end of each row's chain of parents."""
    p = parent
    while not np.array_equal(p, parent[p]):
        p = parent[p]
    return value[p]


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a table counted to hold at most BROADCAST_ROWS rows of a few numbers; beyond, Spark joins by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def groups(sets: DataFrame, n_sets: int) -> DataFrame:
    """(sid, rep, n, g) for staged sets (sid, rep, n, tokens): g = struct(rep, sid) of the group's leader.

    After the first level (inside Arrow batches) only leaders whose min-hash
    another leader has too are brought together, by that key.
    """
    level = stage_table(sets.mapInArrow(_cluster_rows(list(range(ROUNDS)), False), _LINKED), "jaccard-groups")
    labels = level.select("sid", "rep", "n", F.struct(F.col("parent_rep").alias("rep"), F.col("parent_sid").alias("sid")).alias("g")).dropDuplicates(["sid"])
    leaders = level.where("sid = parent_sid").select("sid", "keys").dropDuplicates(["sid"])
    for r in range(ROUNDS):
        keyed = leaders.select("sid", F.col("keys")[r].alias("key"))
        meets = keyed.groupBy("key").count().where("count > 1").select("key")
        called = stage_table(keyed.join(meets, "key"), "jaccard-called")
        together = sets.join(small(called, n_sets), "sid").repartition("key").sortWithinPartitions("key")
        moved = together.select("sid", "rep", "n", "tokens").mapInArrow(_cluster_rows([r], True), _LINKED)
        moved = stage_table(moved.select(F.col("sid").alias("from_sid"), F.struct(F.col("parent_rep").alias("rep"), F.col("parent_sid").alias("sid")).alias("to")).dropDuplicates(["from_sid"]), "jaccard-moved")
        labels = labels.join(moved, F.col("g.sid") == F.col("from_sid"), "left").select("sid", "rep", "n", F.coalesce("to", "g").alias("g"))
        leaders = leaders.join(moved, F.col("sid") == F.col("from_sid"), "left_anti")
    return stage_table(labels, "jaccard-labels")


def _grouped_sets(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    tokens, n = _tokens(b)
    sid, first = np.unique(b.column("sid").to_numpy(), return_index=True)
    end = np.cumsum(n)
    values = [tokens[end[k] - n[k] : end[k]] for k in first]
    return sid, b.column("owner").to_numpy()[first], np.concatenate(values) if values else tokens, np.repeat(np.arange(len(first)), n[first])


def cross_links(sets: DataFrame, labels: DataFrame, n_sets: int, n_tokens: int) -> DataFrame:
    """(qg, xg): pairs of groups that hold linked classes, by the token-group matrix."""
    near = stage_table(labels.select("sid", "n", "g", F.xxhash64("g").alias("owner")), "jaccard-owners")
    # rule out what shares too little with other groups, until that rules out little more
    left = n_sets
    while left:
        owned = sets.join(small(near.select("sid", "owner"), left), "sid").select("sid", "owner", "tokens")
        counted = shared_counts(owned, _grouped_sets, n_tokens)
        near = stage_table(near.join(counted.withColumnRenamed("set", "sid"), "sid").where(F.col("shared") >= F.ceil(F.col("n") * 0.75)).drop("shared"), "jaccard-near")
        before, (left, n_tokens) = left, near.select(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if left > 0.8 * before:
            break
    token_rows = sets.join(small(near, left), "sid").select("sid", "owner", "tokens").dropDuplicates(["sid"]).mapInArrow(_token_rows, "sid long, owner long, token long")
    cells = stage_table(token_rows, "jaccard-cells")
    often = stage_table(cells.select("token", "owner").distinct().groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "jaccard-often")
    held = cells.join(often, "token")
    # kin: classes with the same most frequent token and about the same size; their parts hold about OPENED classes each
    pivot = held.groupBy("sid").agg(F.max(F.struct("df", F.col("token").alias("t"))).alias("p"), F.count("*").alias("held")).join(near, "sid")
    kin = pivot.select("sid", "n", "held", "g", "owner", F.xxhash64("p.t", F.floor(F.log("n") / BAND)).alias("kin"))
    parts = kin.groupBy("kin").agg(F.ceil(F.count("*") / OPENED).alias("parts"))
    placed = kin.join(parts, "kin").withColumn("part", _part("sid"))
    placed = stage_table(placed.select("sid", "n", "held", "kin", "parts", "part", "g", "owner"), "jaccard-placed")
    # the token-group matrix, and of each class the rarest floor(n / 4) + ceil(n / 16) tokens; those that only one
    # group of linked classes holds come first and cannot be elsewhere
    sizes = placed.groupBy("kin").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    cells = held.select("sid", "token").join(placed.select("sid", "kin"), "sid").select("token", "kin").distinct()
    matrix = stage_table(cells.join(sizes, "kin"), "jaccard-matrix")
    spread = matrix.groupBy("token").agg(F.count("*").alias("in_kin"))
    first = F.floor(F.col("n") / 4) + F.ceil(F.col("n") / 16)
    ranked = held.join(spread, "token").withColumn("r", F.row_number().over(Window.partitionBy("sid").orderBy("in_kin", "df", "token"))).join(placed.select("sid", "n", "held", F.col("kin").alias("own_kin")), "sid")
    probes = ranked.where(F.col("r") <= first - (F.col("n") - F.col("held"))).select("sid", "token", "n", "own_kin")
    # a partner x among other kin shares at least 3 / 7 (n + |x|) tokens, |x| >= max(0.75 n, smallest set of the kin);
    # so many of those tokens must be in the kin's union.  A class's own kin is opened in any case.
    other = (F.col("kin") != F.col("own_kin")) & (F.col("hi") * 4 >= F.col("n") * 3) & (F.col("lo") * 3 <= F.col("n") * 4)
    shared = probes.withColumnRenamed("token", "t").join(matrix, (F.col("t") == F.col("token")) & other).groupBy("sid", "kin", "n", "lo").agg(F.count("*").alias("hits"))
    need = F.ceil(3 * (F.col("n") + F.greatest("lo", F.ceil(F.col("n") * 0.75))) / 7)
    reached = shared.where(F.col("hits") >= F.greatest(F.lit(1), first - F.col("n") + need)).select("sid", "kin")
    ways = stage_table(reached.union(placed.select("sid", "kin")), "jaccard-ways")
    placed = placed.select("sid", "kin", "parts", "part", "g", "owner")
    large = placed.where("parts > 1")
    links = []
    if not large.isEmpty():  # what large kin hold becomes few components before classes ask all their parts
        dealt = large.select("sid", "g", "owner", F.explode(F.array("part", F.xxhash64(_part(F.xxhash64("sid"))))).alias("part"))
        inside = sets.select("sid", "tokens").join(small(dealt, 2 * left), "sid").select("part", "tokens", "g", "owner").groupBy("part")
        links.append(stage_table(inside.applyInArrow(_inside, _LINKS), "jaccard-inside"))
        placed = _relabelled(placed, links[-1], left)
        of = placed.groupBy("owner", "kin").agg(F.min("sid").alias("a"), F.max("sid").alias("z"))
        scouts = of.select(F.explode(F.array("a", "z")).alias("sid")).distinct()
        asked = _asking(placed, ways.join(scouts, "sid"), left)
        links.append(_links(sets, placed, asked, left))
        placed = _relabelled(placed, links[-1], left)
        links.append(_links(sets, placed, _asking(placed, ways, left).join(asked.select("sid", "part"), ["sid", "part"], "left_anti"), left))
    else:
        links.append(_links(sets, placed, _asking(placed, ways, left), left))
    return stage_table(reduce(DataFrame.union, links).distinct(), "jaccard-links")


def _part(of) -> Column:
    """One of its kin's parts for each class."""
    return F.xxhash64("kin", F.pmod(F.xxhash64(of), F.col("parts")))


def _relabelled(placed: DataFrame, links: DataFrame, n_placed: int) -> DataFrame:
    """``placed`` with the components that ``links`` make of its groups in their place."""
    roots = merged(links)
    if roots is None:
        return placed
    g = F.coalesce("root", "g")
    return stage_table(placed.join(small(roots, n_placed), "g", "left").withColumn("owner", F.xxhash64(g)).withColumn("g", g).drop("root"), "jaccard-placed")


def _asking(placed: DataFrame, ways: DataFrame, n_placed: int) -> DataFrame:
    """(sid, part, g, owner): of ``ways`` (sid, kin) the parts that hold a class of a larger component, of equal ones the greater owner."""
    sizes = placed.groupBy("owner").agg(F.count("*").alias("size"))
    sized = placed.join(small(sizes, n_placed), "owner").withColumn("rank", F.struct("size", "owner"))
    tops = stage_table(sized.groupBy("kin", "part").agg(F.max("rank").alias("top")), "jaccard-tops")
    most = tops.groupBy("kin").agg(F.max("top").alias("most"))
    lower = ways.join(sized.select("sid", "g", "owner", "rank"), "sid").join(small(most, n_placed), "kin").where("rank < most")
    return stage_table(lower.join(small(tops, n_placed), "kin").where("rank < top").select("sid", "part", "g", "owner"), "jaccard-asking")


def _links(sets: DataFrame, placed: DataFrame, asking: DataFrame, n_placed: int) -> DataFrame:
    """(qg, xg): a spanning forest for each part of the links that the ``asking`` classes have in it."""
    left = sets.select("sid", "tokens").join(small(placed.select("sid", "part", "g", "owner"), n_placed), "sid").groupBy("part")
    asked = sets.select(F.col("sid").alias("q"), F.col("tokens").alias("own")).join(small(asking, asking.count()), F.col("q") == F.col("sid"))
    right = asked.select("part", "g", "owner", "own").groupBy("part")
    return stage_table(left.cogroup(right).applyInArrow(_opened, _LINKS), "jaccard-forest")


def _opened(left, right):
    """Groups of asking classes (right) and members of one part (left), each with the group that its links lead to."""
    empty = pa.Table.from_pydict({"qg": left.column("g").slice(0, 0), "xg": left.column("g").slice(0, 0)})
    if not left.num_rows or not right.num_rows:
        return empty
    tokens, n = _tokens(pa.RecordBatch.from_arrays([left.column("tokens").combine_chunks()], ["tokens"]))
    member = np.repeat(np.arange(len(n)), n)
    order = np.argsort(tokens, kind="stable")
    tokens, member = tokens[order], member[order]
    owners = np.concatenate([left.column("owner").to_numpy(), right.column("owner").to_numpy()])
    _, first, node = np.unique(owners, return_index=True, return_inverse=True)
    parent = np.arange(len(first))
    root = node[: len(n)].copy()  # of each member, as far as links are known
    for raw, at in zip(right.column("own"), node[len(n) :].tolist(), strict=True):
        while parent[at] != at:
            parent[at] = at = parent[parent[at]]
        if (root == at).all():
            continue
        own = np.frombuffer(raw.as_buffer(), "<u8")
        a, z = np.searchsorted(tokens, own), np.searchsorted(tokens, own, side="right")
        if (z > a).sum() < required(len(own)):  # the bound: tokens of the query in the part's union
            continue
        count = z - a
        where = np.arange(count.sum()) + np.repeat(a - (np.cumsum(count) - count), count)
        both = np.bincount(member[where], minlength=len(n))
        for r in np.unique(root[(100 * both >= 75 * (len(own) + n - both)) & (root != at)]):
            parent[r] = at
            root[root == r] = at
    while not np.array_equal(parent, parent[parent]):
        parent = parent[parent]
    moved = np.flatnonzero(parent != np.arange(len(parent)))
    g = pa.chunked_array(left.column("g").chunks + right.column("g").chunks).combine_chunks()
    return pa.table({"qg": g.take(pa.array(first[moved])), "xg": g.take(pa.array(first[parent[moved]]))}) if len(moved) else empty


def _inside(members):
    """Like ``_opened``, with the members of the part themselves asking."""
    return _opened(members, members.select(["g", "owner", "tokens"]).rename_columns(["g", "owner", "own"]))


def _token_rows(batches):
    for b in sliced(batches):
        tokens, n = _tokens(b)
        of = pa.array(np.repeat(np.arange(len(n)), n))
        yield pa.RecordBatch.from_arrays([b.column("sid").take(of), b.column("owner").take(of), pa.array(tokens.view(np.int64))], ["sid", "owner", "token"])


def merged(links: DataFrame) -> DataFrame | None:
    """(g, root) for the groups that ``links`` (qg, xg) touch: smallest group reachable; None without links."""
    edges = links.select("qg", "xg").union(links.select("xg", "qg")).toDF("a", "b").distinct()
    edges = stage_table(edges, "jaccard-edges")
    if edges.isEmpty():
        return None
    label = stage_table(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("l")), "jaccard-merge")
    while True:
        neighbour = edges.join(label.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("l").alias("m"))
        step = label.join(neighbour, "a").select("a", "l", F.least("l", "m").alias("new"))
        jump = step.select(F.col("a").alias("j"), F.col("new").alias("far"))
        new = stage_table(step.join(jump, F.col("new") == F.col("j"), "left").select("a", "l", F.least("new", F.coalesce("far", "new")).alias("new")), "jaccard-merge")
        changed = not new.where("l <> new").isEmpty()
        label = new.select("a", F.col("new").alias("l"))
        if not changed:
            return label.select(F.col("a").alias("g"), F.col("l").alias("root"))


def components(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (an id, text)."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage_table(texts.mapInArrow(_signature_rows, "doc_id long, n long, sid long"), "jaccard-signatures")
    classes = stage_table(signed.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("copies")), "jaccard-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    counted = shared_counts(texts.select("text"), _half_sets, total // 2)
    r = F.ceil(F.col("n") * 0.75)
    possible = stage_table(classes.join(counted.withColumnRenamed("set", "sid"), "sid").where(F.col("shared") >= F.ceil(r / 4)).select("sid", "rep", "n"), "jaccard-possible")
    n_sets, n_tokens = possible.select(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    mine = possible.select("sid", F.col("rep").alias("doc_id"))
    sets = stage_table(texts.join(small(mine, n_sets), "doc_id").select("doc_id", "sid", "text").mapInArrow(_set_rows, "sid long, rep long, n long, tokens binary"), "jaccard-sets")
    labels = groups(sets, n_sets)
    roots = merged(cross_links(sets, labels, n_sets, n_tokens))
    if roots is not None:
        labels = labels.join(roots, "g", "left").withColumn("g", F.coalesce("root", "g"))
    named = classes.join(labels.select("sid", "g"), "sid", "left").where("copies > 1 OR g IS NOT NULL").select("sid", F.coalesce("g.rep", "rep").alias("component_id"))
    out = signed.join(named, "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
