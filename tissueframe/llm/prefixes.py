"""Prefix trie of conversations by adaptive radix trees over turn ids.

Equal turns (role and text) have equal ids of ``ID`` bytes, so a conversation is a byte
key of fixed-width big-endian ids and a node of the trie is a turn-aligned prefix of some
key. Keys are range partitioned by their bytes, sorted, and cut into units of at most
``UNIT`` distinct keys. Each unit grows an adaptive radix tree of its own: inner nodes
widen from 4 to 16, 48 and 256 children, paths without a branch are kept once, and a walk
tells the depths at which a whole turn ends. Memory follows the unit and its keys.

In byte order the keys of a trie node lie side by side. So a unit knows all of a node but
for the prefixes of its first and last key; these open nodes are added up over the units
by a hash of their path. What a subtree sums over its open nodes follows in a second
pass: one unit owns each open node and passes its own part up the two open paths of the
unit, by running sums. No turn or conversation needs a task of its own, however many
conversations begin with it.

Members that end at one node are joined in numeric order for the digest. Ranges of
``(key, conv_id)`` pack their ids in blocks first, so a conversation held by a third of
all members is packed by many tasks; SHA-256 itself goes along the packed blocks one by one.

Defined cases: turns are ordered by ``turn`` (null first), equal turn numbers by the turn
id; null role and text are empty; rows alike are so many turns; rows with a null
``conv_id`` belong to no conversation; an empty table has no node, not even the root; columns other than
``conv_id, turn, role, text`` are not read. Ids are 128-bit hashes (MD5) of role and text; the
texts stay where they are read. The ids of one conversation are one row.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.llm.textops import WORD
from tissueframe.plans.lineage import store
from tissueframe.plans.skew import attach

#: Bytes of a turn id.
ID = 16
#: Distinct keys of one tree.
UNIT = 1 << 15
#: Ids packed in one row.
PACK = 4096

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Node:
    """A node with a compressed path; ``layout`` is the number of children it has room for."""

    __slots__ = ("path", "layout", "keys", "kids", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.value = path, value
        self.layout, self.keys, self.kids = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:  # sorted bytes beside the children
            at = self.keys.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:  # a slot for every byte, counted from 1
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        """Add or replace a child; a full node moves to the next layout."""
        if self.layout <= 16:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.kids[at] = kid
                return
            if len(self.keys) < self.layout:
                self.keys.insert(at, byte)
                self.kids.insert(at, kid)
                return
            self._widen()
            self.put(byte, kid)
        elif self.layout == 48:
            at = self.keys[byte]
            if at:
                self.kids[at - 1] = kid
            elif len(self.kids) < 48:
                self.kids.append(kid)
                self.keys[byte] = len(self.kids)
            else:
                self._widen()
                self.put(byte, kid)
        else:
            self.kids[byte] = kid

    def _widen(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.keys):
                index[byte] = at + 1
            self.layout, self.keys = 48, index
        else:
            kids = [None] * 256
            for byte, at in enumerate(self.keys):
                if at:
                    kids[byte] = self.kids[at - 1]
            self.layout, self.keys, self.kids = 256, None, kids

    def ordered(self) -> list[tuple[int, Node]]:
        """Children by their byte."""
        if self.layout <= 16:
            return list(zip(self.keys, self.kids))
        if self.layout == 48:
            return [(byte, self.kids[at - 1]) for byte, at in enumerate(self.keys) if at]
        return [(byte, kid) for byte, kid in enumerate(self.kids) if kid is not None]


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common beginning of ``a`` and ``b[at:]``."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at : at + n]:
        return n
    low = 0
    while n - low > 1:  # a[:low] agrees, a[:n] does not
        middle = (low + n) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            n = middle
    return low


class RadixTree:
    """Adaptive radix tree from byte keys to values."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = Node(key, value)
            return
        above, edge, node, at = None, 0, self.root, 0
        while True:
            same = common(node.path, key, at)
            if same < len(node.path):  # the paths part here
                upper = Node(node.path[:same])
                upper.put(node.path[same], node)
                node.path = node.path[same + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.put(edge, upper)
                node = upper
            at += same
            if at == len(key):
                node.value = value
                return
            kid = node.child(key[at])
            if kid is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            above, edge, node, at = node, key[at], kid, at + 1

    def turns(self, width: int = ID) -> Iterator[tuple[int, int, object]]:
        """Aligned depths in byte order: ``(depth, index of the parent, value of the key ending there)``.

        Depth 0 comes first, with parent -1.
        """
        if self.root is None:
            return
        count, stack = 0, [(self.root, 0, -1)]
        while stack:
            node, start, parent = stack.pop()
            end = start + len(node.path)
            # An aligned depth at ``start`` belongs to the edge that leads here.
            for place in range(-(-start // width), end // width + 1):
                last = place * width == end
                yield place, parent, node.value if last else None
                parent, count = count, count + 1
            for byte, kid in reversed(node.ordered()):
                stack.append((kid, end + 1, parent))


def turn_id(role: Column, text: Column) -> Column:
    """Id of a turn in hexadecimal digits; the length keeps role and text apart."""
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.md5(named.cast("binary"))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def conversation_rows(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: ids and word counts of every conversation in order. One shuffle, without texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", turn_id(role, text).alias("id"), n_words(text).alias("words")).alias("t")
    )
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")
    )


def _packed(rows: DataFrame) -> DataFrame:
    """``(key, first, n, ids)``: decimal ids of up to :data:`PACK` neighbouring members of one key, comma-joined."""
    ordered = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def run(batches):
        own = []

        def block():
            return {"key": key, "words": words, "first": own[0], "n": len(own), "ids": ",".join(map(str, own))}

        for batch in batches:
            full = []
            for k, w, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if own and (k != key or len(own) >= PACK):
                    full.append(block())
                    own = []
                if not own:
                    key, words = k, w.as_py()
                own.append(c)
            if full:
                yield pa.RecordBatch.from_pylist(full, schema=shape)
        if own:
            yield pa.RecordBatch.from_pylist([block()], schema=shape)

    shape = pa.schema([("key", pa.binary()), ("words", pa.list_(pa.int64())), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
    return ordered.select("key", "words", "conv_id").mapInArrow(run, "key binary, words array<long>, first long, n long, ids string")


_NODE = (
    "unit long, side int, node string, parent string, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string"
)


def unit_nodes(keys: list[bytes], words: list[list[int]], convs: list[int], counts: list[int], digests: list[str]) -> list[tuple]:
    """Nodes of one unit of ascending distinct keys, as tuples of ``_NODE`` without the unit.

    Open nodes (prefixes of the first or last key) have a ``side``: 0 where both keys run
    through, 1 for the first key alone, 2 for the last. Their leaves and tokens count only what
    hangs closed below themselves, and their children only closed ones.
    """
    tree = RadixTree()
    for at, key in enumerate(keys):
        tree.insert(key, at)
    depth, parent, value = zip(*tree.turns())
    n = len(depth)
    first_len, last_len, both = len(keys[0]) // ID, len(keys[-1]) // ID, common(keys[0], keys[-1]) // ID
    # In preorder the first key's path comes first; the last key's path ends at the last node.
    side: list[int | None] = [None] * n
    for i in range(first_len + 1):
        side[i] = 0 if i <= both else 1
    at = n - 1
    while depth[at] > both:
        side[at], at = 2, parent[at]
    names, step = {}, hashlib.md5(b"").hexdigest()
    for which, key, length in ((1, keys[0], first_len), (2, keys[-1], last_len)):
        name = step
        names[0, 0] = step
        for d in range(1, length + 1):
            name = hashlib.md5(name.encode() + key[(d - 1) * ID : d * ID]).hexdigest()
            names[0 if d <= both else which, d] = name
    members, least, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n
    children, closed_below, last = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if value[i] is not None:
            members[i] += counts[value[i]]
            least[i] = convs[value[i]] if least[i] is None else min(least[i], convs[value[i]])
            last[i] = value[i]
        if side[i] is None:
            saved[i] += (members[i] - 1) * words[last[i]][depth[i] - 1]
            leaves[i] += not children[i]
        up = parent[i]
        if up >= 0:
            members[up] += members[i]
            least[up] = least[i] if least[up] is None else min(least[up], least[i])
            last[up] = last[i]
            children[up] += 1
            if side[i] is None:
                closed_below[up] += 1
                saved[up] += saved[i]
                leaves[up] += leaves[i]
    found = []
    for i in range(n):
        up, open_ = parent[i], side[i] is not None
        above = up >= 0 and side[up] is not None
        found.append((
            side[i], names[side[i], depth[i]] if open_ else None, names[side[up], depth[up]] if above else None, least[i], depth[i],
            None if up < 0 or above else least[up], members[i], closed_below[i] if open_ else children[i], leaves[i], saved[i],
            words[last[i]][depth[i] - 1] if depth[i] else 0, None if value[i] is None else digests[value[i]],
        ))
    return found


def _nodes(packed: DataFrame, unit: int) -> DataFrame:
    """Closed and open nodes of all units."""
    ordered = packed.repartitionByRange("key").sortWithinPartitions("key", "first")
    names = [f.split(" ")[0] for f in _NODE.split(", ")]

    def run(batches):
        task, units = TaskContext.get().partitionId(), 0
        held = ([], [], [], [], [])
        key, digest = None, None

        def rows():
            nonlocal held, units
            found = unit_nodes(*held)
            number = [(task << 32) + units] * len(found)
            held, units = ([], [], [], [], []), units + 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((number, *zip(*found)), types)], names=names)

        for batch in batches:
            for k, w, first, n, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if k != key:
                    if key is not None:
                        held[4].append(digest.hexdigest())
                        if len(held[0]) >= unit:
                            yield rows()
                    key, digest = k, hashlib.sha256()
                    for column, v in zip(held, (k, w, first, 0)):
                        column.append(v)
                elif n:
                    digest.update(b",")
                digest.update(ids.encode())
                held[3][-1] += n
        if key is not None:
            held[4].append(digest.hexdigest())
            yield rows()

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[f.split(" ")[1]] for f in _NODE.split(", ")]
    return ordered.select("key", "words", "first", "n", "ids").mapInArrow(run, _NODE)


def _open_nodes(nodes: DataFrame) -> DataFrame:
    """Open nodes added up: one row per node with its ``node`` name and the ``parent`` name."""
    rows = nodes.where("side IS NOT NULL")
    own = rows.groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("_closed"), F.max("words").alias("words"), F.max("ends_sha256").alias("ends_sha256"), F.min("unit").alias("_owner"),
    )
    own = store(own, "open-nodes")
    below = own.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("_open"))
    own = own.join(below, "node", "left").withColumn("n_children", F.col("_closed") + F.coalesce("_open", F.lit(0)))
    own = store(own.drop("_closed", "_open"), "open-nodes")
    # Every unit adds the nodes it owns to what hangs closed below its paths, from the deep end up.
    part = attach(
        rows.select("unit", "side", "node", "depth", "n_leaves", "saved_tokens"),
        own.select("node", "_owner", ((F.col("n_convs") - 1) * F.col("words")).alias("_saved"), (F.col("n_children") == 0).cast("long").alias("_leaf")),
        ["node"], "inner", spread=["unit"],
    )
    mine = F.col("unit") == F.col("_owner")
    part = part.withColumns({
        "n_leaves": F.col("n_leaves") + F.when(mine, F.col("_leaf")).otherwise(0),
        "saved_tokens": F.col("saved_tokens") + F.when(mine, F.col("_saved")).otherwise(0),
    })
    up = Window.partitionBy("unit", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("unit")
    sums = {}
    for c in ("n_leaves", "saved_tokens"):
        # Where both paths run together, all of the paths that part below is below.
        parted = F.when(F.col("side") == 0, F.sum(F.when(F.col("side") > 0, F.col(c)).otherwise(0)).over(whole)).otherwise(0)
        sums[c] = F.sum(c).over(up) + parted
    totals = part.select("node", *[v.alias(c) for c, v in sums.items()]).groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    above = own.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = own.join(totals, "node")
    return store(found.join(above, "parent", "left"), "open-totals")


_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def prefix_trie(conversations: DataFrame, unit: int = UNIT) -> DataFrame:
    """One row per trie node of ``conversations`` (``conv_id, turns``: array of ``id, words``, as :func:`conversation_rows` gives).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (tokens a shared prefix cache saves in the subtree)
    and ``ends_sha256`` over the members that end there.
    """
    rows = conversations.select("conv_id", F.col("turns.words").alias("words"), F.unhex(F.array_join("turns.id", "")).alias("key"))
    nodes = store(_nodes(store(_packed(rows), "packed-members"), unit), "trie-nodes")
    ends = F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")
    merged = _open_nodes(nodes)
    closed = nodes.where("side IS NULL")
    inner = closed.where("parent IS NULL").select(*_OUT, ends)
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("_above"))
    edge = attach(closed.where("parent IS NOT NULL"), parents, ["parent"], spread=["conv_id"])
    edge = edge.withColumn("parent_conv_id", F.col("_above")).select(*_OUT, ends)
    return inner.unionByName(edge).unionByName(merged.select(*_OUT, ends))
