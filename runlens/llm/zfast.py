"""Prefix trie of conversations as a z-fast trie.

A conversation is a string whose letters are its turns (role and text). Every
prefix has a 128-bit hash, chained from turn to turn. The trie is kept
compacted: a node stands for a whole edge, from below its parent's depth to its
own (its extent), with the prefix hashes along it. A node is filed under its
handle, the prefix whose length is the two-fattest number of the edge (the one
divisible by the highest power of two), and under its name, the first prefix of
the edge.

*Locate*: a conversation finds its exit node by fat binary search: it looks up
its prefix of the two-fattest length between what is matched and what is not,
goes on below the node found or above the length tried, and needs a number of
steps in proportion to the logarithm of its length; one look by name ends it.

*Insert in batches* (64ths of the distinct conversations: 1, 7 and 56): the
batch is located in the trie of the earlier ones; edges are cut where its
conversations leave them; beyond that the batch's own prefixes become nodes
where they branch or end.

*Expand*: sums over subtrees are made on the compacted nodes, and each edge is
written out as one row a depth.

All steps are joins and partial aggregations over nodes and strings. Copies of
a conversation are one string with a count. The only things in one row or
group are a conversation's turns, the cuts of one edge (no more than its
turns), and 65,536 consecutive ids at a time: the ids that end at a node are
joined in such runs, and the runs of a node are hashed one after the other as
they stream by, so a group of copies of any size needs no memory. Prefixes are
equal when their 128-bit hashes are.

Defined cases: a null role or text is empty; null turn numbers come first,
equal ones go by role, then MD5 of the text; repeated rows are turns of their
own; rows without a conversation id take no part; a conversation without turns
ends at the root; an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import base

ID_RUN = 65_536                     # consecutive ids joined in one row
BATCHES = ((0, 1), (1, 8), (8, 64))  # of 64 parts by hash
TURNS = "array<struct<digest:binary,chars:bigint>>"
PATH = "conv_id long, n int, hi array<long>, lo array<long>, c array<long>"
KEY = ["depth", "hi", "lo"]


def ordered(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id``, ``turns``: digest and code points of each turn, in order."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), F.md5(text.cast("binary")).alias("tie"),
                    F.unhex(F.md5(whole.cast("binary"))).alias("digest"), F.length(text).cast("long").alias("chars"))
    listed = (rows.where(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).alias("conv_id"))
              .agg(F.sort_array(F.collect_list(turn)).alias("turns")))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["chars"])).cast(TURNS).alias("turns"))


def chained(batches):
    """Prefix hashes (two longs) and code points up to each depth."""
    import pyarrow as pa

    for batch in batches:
        ids, turns = batch.column("conv_id"), batch.column("turns")
        sizes = np.diff(turns.offsets.to_numpy())
        flat = turns.flatten()
        digests, chars = flat.field("digest").to_pylist(), flat.field("chars").to_numpy(zero_copy_only=False)
        hashes, at = [], 0
        for size in sizes:
            h = bytes(16)
            for d in digests[at: at + size]:
                h = hashlib.blake2b(h + d, digest_size=16).digest()
                hashes.append(h)
            at += size
        pair = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        run = np.concatenate([[0], np.cumsum(chars)])
        below = np.repeat(run[ends[:-1]], sizes)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(v), pa.int64()))
                 for v in (pair[:, 0], pair[:, 1], run[1:] - below)]
        yield pa.RecordBatch.from_arrays([ids, pa.array(sizes.astype(np.int32)), *lists],
                                         names=["conv_id", "n", "hi", "lo", "c"])


def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the highest power of two divides."""
    top = F.length(F.bin(a.bitwiseXOR(b).cast("long"))) - 1
    return b.bitwiseAND(F.call_function("shiftleft", F.lit(-1), top)).cast("int")


def node_row(lower: Column, upper: Column, start: Column, p_hi: Column, p_lo: Column, p_c: Column) -> list[Column]:
    """Columns of the node for depths (lower, upper], cut from arrays ``hi``,
    ``lo``, ``c`` that begin below depth ``start``; ``p_*`` hold at ``start``."""
    def cut(name: str) -> Column:
        return F.slice(name, (lower - start + 1).cast("int"), (upper - lower).cast("int"))

    def before(name: str, at_start: Column) -> Column:
        return F.when(lower == start, at_start).otherwise(F.get(name, (lower - start - 1).cast("int")))

    f = two_fattest(lower, upper)
    return [lower.cast("int").alias("parent_len"), upper.cast("int").alias("depth"),
            cut("hi").alias("e_hi"), cut("lo").alias("e_lo"), cut("c").alias("e_c"),
            before("hi", p_hi).alias("p_hi"), before("lo", p_lo).alias("p_lo"), before("c", p_c).alias("p_c"),
            F.get("hi", (upper - start - 1).cast("int")).alias("hi"), F.get("lo", (upper - start - 1).cast("int")).alias("lo"),
            f.alias("f"), F.get("hi", (f - start - 1).cast("int")).alias("f_hi"),
            F.get("lo", (f - start - 1).cast("int")).alias("f_lo")]


def located(strings: DataFrame, nodes: DataFrame | None, longest: int) -> DataFrame:
    """``strings`` with ``lcp`` (turns that the trie has) and, where they leave
    it inside an edge, that node's key (``x_depth``, ``x_hi``, ``x_lo``)."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (("x_depth", "int"), ("x_hi", "long"), ("x_lo", "long"))]
    if nodes is None:
        return strings.select("*", F.lit(0).alias("lcp"), *none)
    node = nodes.select(F.struct("parent_len", "depth", "hi", "lo", "e_hi", "e_lo").alias("node"), "parent_len", "f", "f_hi", "f_lo")
    state = strings.select("*", F.lit(0).alias("a"), F.col("n").alias("b"),
                           F.lit(None).cast(node.schema["node"].dataType).alias("exit"))
    own = [F.lit(-1), F.col("conv_id"), F.col("conv_id")]       # finds nothing, and spreads

    def look(by: list[str], key: list[Column]) -> DataFrame:
        other = node.select("node", *[F.col(c).alias(f"k{i}") for i, c in enumerate(by)])
        return state.select("*", *[k.alias(f"q{i}") for i, k in enumerate(key)]).join(
            other, [F.col(f"q{i}") == F.col(f"k{i}") for i in range(3)], "left").drop("q1", "q2", "k0", "k1", "k2")

    for _ in range(max(1, longest).bit_length() + 1):
        going = (F.col("a") < F.col("b")) & F.col("exit").isNull()
        f = two_fattest(F.col("a"), F.col("b"))
        tried = look(["f", "f_hi", "f_lo"], [F.when(going, k).otherwise(o) for k, o in zip(
            (f, F.get("hi", f - 1), F.get("lo", f - 1)), own)])
        end = F.col("node.depth")
        hit = F.col("node").isNotNull()
        whole = hit & (end <= F.col("n")) & (F.get("hi", end - 1) == F.col("node.hi")) & (F.get("lo", end - 1) == F.col("node.lo"))
        state = tried.select(
            *strings.columns, F.when(whole, end).otherwise(F.col("a")).alias("a"),
            F.when(~hit & (F.col("q0") > 0), F.col("q0") - 1).otherwise(F.col("b")).alias("b"),
            F.when(hit & ~whole, F.col("node")).otherwise(F.col("exit")).alias("exit"))
    # by name: the child that begins with the next turn
    going = (F.col("a") < F.col("n")) & F.col("exit").isNull()
    name = node.select("node", "parent_len", F.get(F.col("node.e_hi"), 0).alias("name_hi"), F.get(F.col("node.e_lo"), 0).alias("name_lo"))
    node = name
    state = look(["parent_len", "name_hi", "name_lo"], [F.when(going, k).otherwise(o) for k, o in zip(
        (F.col("a"), F.get("hi", F.col("a")), F.get("lo", F.col("a"))), own)])
    exits = F.coalesce("exit", "node")
    state = state.select(*strings.columns, "a", exits.alias("exit"))
    x = F.col("exit")
    same = F.filter(F.sequence(x["parent_len"] + 1, F.least(x["depth"], F.col("n"))), lambda d: (
        F.get("hi", d - 1) == F.get(x["e_hi"], d - x["parent_len"] - 1)) & (F.get("lo", d - 1) == F.get(x["e_lo"], d - x["parent_len"] - 1)))
    lcp = F.when(x.isNull(), F.col("a")).otherwise(x["parent_len"] + F.size(same))
    return state.select(*strings.columns, lcp.alias("lcp"), x["depth"].alias("x_depth"), x["hi"].alias("x_hi"), x["lo"].alias("x_lo"))


def inserted(batch: DataFrame, nodes: DataFrame | None, longest: int, land: base.Landing, name: str) -> DataFrame:
    """The node table with the strings of ``batch`` in it."""
    spots = land.put(located(batch, nodes, longest), f"{name}-located")
    # prefixes beyond the exit: nodes where they branch or end
    tail = (spots.where("lcp < n").select("conv_id", "n", "lcp", "hi", "lo", F.explode(F.expr("sequence(lcp + 1, n)")).alias("depth"))
            .select("conv_id", "lcp", "depth", F.get("hi", F.col("depth") - 1).alias("hi"), F.get("lo", F.col("depth") - 1).alias("lo"),
                    F.get("hi", F.col("depth")).alias("next_hi"), F.get("lo", F.col("depth")).alias("next_lo"),
                    (F.col("depth") == F.col("n")).alias("ends")))
    seen = tail.groupBy(*KEY).agg(F.min("next_hi").alias("a"), F.max("next_hi").alias("b"), F.min("next_lo").alias("c"),
                                  F.max("next_lo").alias("d"), F.max("ends").alias("ends"), F.min("conv_id").alias("rep"))
    marks = land.put(seen.where("ends or a <> b or c <> d").select(*KEY, "rep"), f"{name}-marks")
    on_path = (tail.select("conv_id", "lcp", *KEY).join(marks, KEY)
               .groupBy("conv_id", "lcp").agg(F.sort_array(F.collect_list(F.struct("depth", (F.col("rep") == F.col("conv_id")).alias("own")))).alias("m")))
    spans = on_path.select("conv_id", F.explode(F.filter(F.transform("m", lambda x, i: F.struct(
        F.when(i == 0, F.col("lcp")).otherwise(F.get("m", i - 1)["depth"]).alias("lower"), x["depth"].alias("upper"), x["own"].alias("own"))),
        lambda x: x["own"])).alias("s"))
    zero = F.lit(0)
    long_zero = zero.cast("long")
    fresh = (spans.select("conv_id", "s.lower", "s.upper").join(spots.select("conv_id", "hi", "lo", "c"), "conv_id")
             .select(F.col("conv_id").alias("rep"), *node_row(F.col("lower"), F.col("upper"), zero, long_zero, long_zero, long_zero)))
    if nodes is not None:
        cuts = (spots.where("x_depth is not null").select(F.col("x_depth").alias("depth"), F.col("x_hi").alias("hi"), F.col("x_lo").alias("lo"), "lcp")
                .groupBy(*KEY).agg(F.sort_array(F.collect_set("lcp")).alias("cuts")))
        edges = nodes.join(cuts, KEY, "left").withColumn("bounds", F.concat(
            F.array("parent_len"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("depth")))
        pieces = edges.select("rep", F.col("parent_len").alias("start"), F.col("e_hi").alias("hi"), F.col("e_lo").alias("lo"),
                              F.col("e_c").alias("c"), "p_hi", "p_lo", "p_c",
                              F.explode(F.transform(F.slice("bounds", F.lit(2), F.size("bounds") - 1), lambda u, i: F.struct(
                                  F.get("bounds", i).alias("lower"), u.alias("upper")))).alias("s"))
        fresh = fresh.unionByName(pieces.select("rep", *node_row(
            F.col("s.lower"), F.col("s.upper"), F.col("start"), F.col("p_hi"), F.col("p_lo"), F.col("p_c"))))
    return land.put(fresh, f"{name}-nodes")


def ends_of(paths: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256): SHA-256 of the ids that end there, in
    order, joined by commas."""
    runs = (paths.select(F.col("n").alias("depth"), last("hi"), last("lo"), "conv_id",
                         F.floor(F.col("conv_id") / ID_RUN).cast("long").alias("run"))
            .groupBy(*KEY, "run").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
            .select(*KEY, "run", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def stream(batches):
        import pyarrow as pa

        now, state = None, None
        for batch in batches:
            done = []
            depth, hi, lo, ids = (batch.column(c).to_pylist() for c in ("depth", "hi", "lo", "ids"))
            for key, text in zip(zip(depth, hi, lo), ids):
                if key != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "ends_sha256"), d)) for d in done], schema=out)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip((*KEY, "ends_sha256"), (*now, state.hexdigest())))], schema=out)

    import pyarrow as pa

    out = pa.schema([("depth", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("ends_sha256", pa.string())])
    return (runs.repartition(*KEY).sortWithinPartitions(*KEY, "run")
            .mapInArrow(stream, "depth int, hi long, lo long, ends_sha256 string"))


def last(name: str) -> Column:
    return F.coalesce(F.get(name, F.col("n") - 1), F.lit(0).cast("long")).alias(name)


def build(conversations: DataFrame, land: base.Landing) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paths, strings, nodes) of conversations with ``conv_id``, ``turns``:
    every conversation's prefix hashes; the different ones, with the number
    (``cnt``) and smallest id of their copies; the compacted trie."""
    paths = land.put(conversations.select("conv_id", "turns").mapInArrow(chained, PATH), "paths")
    same = (paths.groupBy(F.col("n").alias("depth"), last("hi"), last("lo"))
            .agg(F.count("*").alias("cnt"), F.min("conv_id").alias("conv_id")))
    strings = land.put(same.select("conv_id", "cnt").join(paths, "conv_id")
                       .withColumn("part", F.pmod(F.xxhash64("conv_id"), F.lit(64))), "strings")
    nodes = None
    for i, (first, after) in enumerate(BATCHES):
        batch = strings.where((F.col("part") >= first) & (F.col("part") < after) & (F.col("n") > 0)).drop("part", "cnt")
        longest = batch.agg(F.max("n")).first()[0] or 0
        nodes = inserted(batch, nodes, longest, land, f"batch{i}")
        if i:
            land.drop(f"batch{i - 1}-nodes")
        land.drop(f"batch{i}-located", f"batch{i}-marks")
    return paths, strings, nodes


def expanded(paths: DataFrame, strings: DataFrame, nodes: DataFrame, land: base.Landing) -> DataFrame:
    """One row a trie node of any depth; see the module's text."""
    kids = nodes.groupBy(F.col("parent_len").alias("depth"), F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo")).agg(
        F.count("*").alias("kids"))
    ends = strings.select(F.col("n").alias("depth"), last("hi"), last("lo"), "cnt", F.col("conv_id").alias("first"))
    long_zero = F.lit(0).cast("long")
    known = land.put(nodes.join(kids, KEY, "left").join(ends, KEY, "left").join(ends_of(paths), KEY, "left").withColumns({
        "kids": F.coalesce("kids", long_zero), "cnt": F.coalesce("cnt", long_zero),
        "c_end": F.element_at("e_c", -1), "edge": F.element_at("e_c", -1) - F.col("p_c")}), "known")
    # each node counts for the prefixes it lies under: partial sums by prefix
    below = known.select("rep", "depth", "cnt", "first", (F.col("kids") == 0).cast("long").alias("leaf"), "c_end", "edge")
    sums = [F.sum("cnt").alias("n_convs"), F.min("first").alias("conv"), F.sum("leaf").alias("leaves"),
            F.sum(F.col("cnt") * F.col("c_end")).alias("told"), F.sum("edge").alias("held")]
    under = (below.join(strings.select(F.col("conv_id").alias("rep"), "hi", "lo"), "rep")
             .select("cnt", "first", "leaf", "c_end", "edge", F.explode(F.transform(
                 F.sequence(F.lit(1), F.col("depth")), lambda d: F.struct(d.alias("depth"), F.get("hi", d - 1).alias("hi"),
                                                                       F.get("lo", d - 1).alias("lo")))).alias("p"))
             .groupBy("p.depth", "p.hi", "p.lo").agg(*sums))
    whole = land.put(known.join(under, KEY), "sums")
    turnless = strings.where("n = 0").select("cnt", F.col("conv_id").alias("first"), long_zero.alias("leaf"),
                                             long_zero.alias("c_end"), long_zero.alias("edge"))
    top = land.put(below.drop("rep", "depth").unionByName(turnless).agg(*sums).where("n_convs > 0").select(
        F.lit(0).alias("depth"), long_zero.alias("hi"), long_zero.alias("lo"), "*"), "top")
    parents = whole.select(*KEY, "conv").unionByName(top.select(*KEY, "conv")).select(
        F.col("depth").alias("parent_len"), F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("conv").alias("parent"))
    rows = (whole.join(parents, ["parent_len", "p_hi", "p_lo"])
            .select("*", F.posexplode("e_c").alias("i", "c_here"))
            .withColumn("c_before", F.when(F.col("i") == 0, F.col("p_c")).otherwise(F.get("e_c", F.col("i") - 1))))
    bottom = F.col("i") == F.col("depth") - F.col("parent_len") - 1
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    saved = (F.col("told") - F.col("n_convs") * F.col("c_before")) - (F.col("held") - F.col("edge") + F.col("c_end") - F.col("c_before"))
    inner = rows.select(
        F.col("conv").alias("conv_id"), (F.col("parent_len") + F.col("i") + 1).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("parent")).otherwise(F.col("conv")).alias("parent_conv_id"), "n_convs",
        F.when(bottom, F.col("kids")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"), F.when(bottom, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"))
    root = (top.join(kids, KEY, "left").join(ends_of(paths.where("n = 0")), KEY, "left")
            .select(F.col("conv").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
                    "n_convs", F.coalesce("kids", long_zero).alias("n_children"), F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
                    (F.col("told") - F.col("held")).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256")))
    return inner.unionByName(root)


def trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of ``conversations`` (``conv_id``, ``turns`` as
    ``ordered`` gives them): ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    land = base.Landing(base.session_of(conversations), "zfast")
    return expanded(*build(conversations, land), land)


def rebuilt(turns: DataFrame, every: int = 100, opening: int = 6) -> DataFrame:
    """Conversations that begin as the one at their hundred does: the first h
    turns of conversation c - c % 100 (all if fewer, none if it is absent),
    then c's own after its first h; h = crc32(decimal c) % 6."""
    first = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("origin"), F.slice("turns", 1, opening - 1).alias("opening"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % opening).cast("int")
    shared = F.slice(F.coalesce("opening", F.array().cast(TURNS)), F.lit(1), h)
    own = F.slice("turns", h + 1, F.size("turns"))
    return (turns.withColumn("origin", F.col("conv_id") - F.col("conv_id") % every).join(first, "origin", "left")
            .select("conv_id", F.concat(shared, own).alias("turns")))


#: The same nodes as prefix lists, for the checks; crc32 by its bit rule.
SQL = """
with recursive said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
told as materialized (
  select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, md5(text)) as turns from said group by conv_id),
crc as (
  select conv_id, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: ord(x)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, k: case when r % 2 = 1 then xor(r // 2, 3988292384::bigint) else r // 2 end)),
    4294967295::bigint) % 6 as h, turns from told),
again as materialized (
  select c.conv_id, list_concat(coalesce(list_slice(o.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) as turns
  from crc c left join told o on o.conv_id = c.conv_id - c.conv_id % 100),
member as materialized (
  select conv_id, len(turns) as n, unnest(range(0, len(turns) + 1)) as depth, turns from again),
keyed as materialized (
  select conv_id, n, depth, cast(list_slice(turns, 1, depth) as varchar) as raw, sha256(cast(to_json(list_slice(turns, 1, depth)) as varchar)) as node,
    case when depth > 0 then sha256(cast(to_json(list_slice(turns, 1, depth - 1)) as varchar)) end as up,
    case when depth > 0 then length(turns[depth]['text']) else 0 end as chars from member),
nodes as materialized (
  select node, any_value(up) as up, depth, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (n = depth), '')) as ends_sha256
  from keyed group by node, depth),
kids as materialized (select up as node, count(*) as n from nodes where up is not null group by up),
line as (
  select node as top, node, up, depth, chars, n_convs, conv_id from nodes
  union all
  select p.node, l.node, p.up, p.depth, l.chars, l.n_convs, l.conv_id from line l join nodes p on p.node = l.up),
subtree as (
  select l.top, sum(case when k.n is null then 1 else 0 end) as n_leaves, sum((l.n_convs - 1) * l.chars) as saved
  from line l left join kids k on k.node = l.node group by l.top)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, cast(coalesce(k.n, 0) as bigint) as n_children,
  cast(s.n_leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens, n.ends_sha256
from nodes n left join nodes p on p.node = n.up left join kids k on k.node = n.node join subtree s on s.top = n.node
"""
