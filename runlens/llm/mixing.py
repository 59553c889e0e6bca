"""Mixing sources to target weights: a token budget is passed down a tree of
columns (domain, language, source) and every leaf takes a prefix of its
seeded epochs.

Each node's share of its parent's budget follows its weight among its
siblings. A node takes no more than its subtree holds (its tokens times the
number of epochs); what it cannot take goes to its siblings, by weight, before
any of it goes back up: a parent's own share is bounded by its subtree, so
only what all children together lack reaches the parent's siblings. Per family
this is one sorted pass: nodes by tokens per weight, the running sums tell who
is full, the rest is divided by running weights so that it adds up exactly.

A leaf with budget ``a`` and ``t`` tokens gives ``a div t`` whole epochs and,
of the next one, the documents in seeded hash order while the tokens before
them are below ``a mod t``. That order is cut in two steps, by 4096 slots of
the hash and then within the one slot that holds the cut, so a leaf with a
third of all rows is never sorted as a whole.

DataFrame functions only. Defined cases: a null path value is a node of its
own, as the empty text; documents without tokens (null or empty text) follow
the hash order and cost nothing, in a leaf without any token they are left
out; weight 0 leaves a node out; unlisted nodes have weight 1; equal rows and
rows with a null id share one place in the order and are taken together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

SLOT_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weight_of(level: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1).cast("long")
    for name, weight in sorted(weights.items()):
        out = F.when(level == name, F.lit(int(weight)).cast("long")).otherwise(out)
    return out


def leaf_budgets(leaves: DataFrame, keys: Sequence[str], weights: Sequence[Mapping[str, int]],
                 share: tuple[int, int], epochs: int) -> DataFrame:
    """(keys, tokens, budget) per leaf from (keys, tokens)."""
    caps = leaves.withColumn("cap", F.col("tokens") * epochs)
    for key, own in zip(keys, weights):      # a node of weight 0 holds nothing
        caps = caps.withColumn("cap", F.when(weight_of(F.col(key), own) == 0, 0).otherwise(F.col("cap")))
    total = F.expr(f"least(sum(tokens) * {int(share[0])} div {int(share[1])}, sum(cap))")
    given = caps.agg(total.cast("long").alias("budget"))
    for depth, own in enumerate(weights):
        upper, here = list(keys[:depth]), list(keys[: depth + 1])
        level = caps.groupBy(*here).agg(F.sum("cap").alias("cap"))
        if upper:
            level = level.join(given, upper)
        else:
            level = level.crossJoin(F.broadcast(given))    # one row: the whole budget
        level = level.withColumn("w", weight_of(F.col(keys[depth]), own))
        family = Window.partitionBy(*upper) if upper else Window.partitionBy(F.lit(0))
        order = [F.col("cap") / F.greatest("w", F.lit(1)), F.col(keys[depth])]
        before = family.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        onward = family.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
        upto = family.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        wide = "decimal(38,0)"
        level = (level
                 .withColumn("room", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                 .withColumn("w_on", F.sum("w").over(onward))
                 .withColumn("full", F.col("cap").cast(wide) * F.col("w_on") <= F.col("room").cast(wide) * F.col("w"))
                 .withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(family))
                 .withColumn("w_open", F.when(F.col("full"), 0).otherwise(F.col("w")))
                 .withColumn("w_all", F.sum("w_open").over(family))
                 .withColumn("w_upto", F.sum("w_open").over(upto)))
        given = level.select(*here, F.expr(
            "case when full then cap else rest * w_upto div w_all - rest * (w_upto - w_open) div w_all end")
            .cast("long").alias("budget"))
    return leaves.join(given, list(keys))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def slot_of(key: Column) -> Column:
    return F.conv(F.substring(key, 1, SLOT_DIGITS), 16, 10).cast("int")


def plan(rows: DataFrame, keys: Sequence[str], weights: Sequence[Mapping[str, int]], share: tuple[int, int],
         epochs: int, seed: int, land: base.Landing) -> DataFrame:
    """(keys, tokens, budget, whole epochs, last key of the part epoch or
    null) per leaf, from rows (id, keys, tokens)."""
    leaves = land.put(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "leaves")
    budgets = leaf_budgets(leaves, keys, weights, share, epochs)
    budgets = land.put(budgets
                       .withColumn("whole", F.expr("case when tokens > 0 then budget div tokens else 0 end"))
                       .withColumn("part", F.expr("case when tokens > 0 then budget % tokens else 0 end")), "budgets")
    open_leaves = budgets.where("part > 0").select(*keys, "whole", "part")
    keyed = (rows.join(open_leaves, list(keys))
             .withColumn("key", order_key(seed, F.col("whole"), F.col("id")))
             .withColumn("slot", slot_of(F.col("key"))))
    slots = keyed.groupBy(*keys, "slot", "part").agg(F.sum("tokens").alias("n"))
    so_far = Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = (slots.withColumn("end", F.sum("n").over(so_far))
          .where((F.col("end") >= F.col("part")) & (F.col("end") - F.col("n") < F.col("part")))
          .select(*keys, "slot", (F.col("end") - F.col("n")).alias("start")))
    at = land.put(at, "slots")
    inner = keyed.join(at, [*keys, "slot"]).groupBy(*keys, "slot", "key", "part", "start").agg(F.sum("tokens").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (inner.withColumn("before", F.col("start") + F.sum("n").over(upto) - F.col("n"))
           .where(F.col("before") < F.col("part")).groupBy(*keys).agg(F.max("key").alias("last")))
    return land.put(budgets.join(cut, list(keys), "left"), "plan")


def mixed(docs: DataFrame, path: Sequence[Column], weights: Sequence[Mapping[str, int]], share: tuple[int, int] = (4, 5),
          epochs: int = 1, seed: int = 7, tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          with_epoch: str | None = None) -> DataFrame:
    """The chosen documents, all columns as they are, once for each epoch they
    are in (``with_epoch`` names a column for it).

    ``path`` are the columns of the tree from the root, ``weights`` a mapping
    for each, ``share`` the budget as a fraction of all tokens.
    """
    land = base.Landing(base.session_of(docs), "mixing")
    keys = [f"__k{i}" for i in range(len(path))]
    named = [F.coalesce(p.cast("string"), F.lit("")).alias(k) for p, k in zip(path, keys)]
    size = tokens if tokens is not None else word_count(F.col(text_col))
    rows = land.put(docs.select(F.col(id_col).alias("id"), *named, size.alias("tokens")), "rows")
    leaves = plan(rows, keys, weights, share, epochs, seed, land).select(
        *keys, F.col("whole").alias("__whole"), F.col("last").alias("__last"))
    land.drop("rows")
    # a row for each leaf, of known size: broadcast by the planner where small
    wide = docs.select(*[F.col(c) for c in docs.columns], *named).join(leaves, keys)
    in_part = F.coalesce(order_key(seed, F.col("__whole"), F.col(id_col)) <= F.col("__last"), F.lit(False))
    count = F.col("__whole") + F.when(in_part, 1).otherwise(0)
    if epochs == 1 and with_epoch is None:
        return wide.where(count > 0).select(*docs.columns)
    epoch = with_epoch or "__epoch"
    out = wide.withColumn("__n", count).where("__n > 0")
    out = out.withColumn(epoch, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    return out.select(*docs.columns, *([epoch] if with_epoch else []))


def sql(weights: Sequence[Mapping[str, int]], share: tuple[int, int], epochs: int, seed: int, path: Sequence[str],
        table: str = "documents") -> str:
    """The same selection as DuckDB SQL: doc_id, k0.., tokens, epoch."""
    n = len(path)
    keys = [f"k{i}" for i in range(n)]

    def weight(i: int) -> str:
        cases = " ".join(f"when '{k}' then {v}" for k, v in sorted(weights[i].items()))
        return f"cast(case k{i} {cases} else 1 end as bigint)" if cases else "cast(1 as bigint)"

    zero = " or ".join(f"{weight(i)} = 0" for i in range(n))
    out = [f"""rows_ as (select doc_id, {', '.join(f"coalesce({p}, '') k{i}" for i, p in enumerate(path))},
  cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) tokens from {table})""",
           f"leaves as (select {', '.join(keys)}, cast(sum(tokens) as bigint) tokens from rows_ group by all)",
           f"caps as (select *, case when {zero} then 0 else tokens * {epochs} end cap from leaves)",
           f"g0 as (select cast(least(sum(tokens) * {share[0]} // {share[1]}, sum(cap)) as bigint) budget from caps)"]
    for i in range(n):
        here, upper = ", ".join(keys[: i + 1]), ", ".join(keys[:i])
        part = f"partition by {upper}" if upper else ""
        join = f"join g{i} using ({upper})" if upper else "cross join g0"
        order = f"order by cap / greatest(w, 1), k{i}"
        out.append(f"""n{i} as (select *, {weight(i)} w from
  (select {here}, cast(sum(cap) as hugeint) cap from caps group by all) {join})""")
        out.append(f"""f{i} as (select *, cap * sum(w) over ({part} {order} rows between current row and unbounded following)
  <= (budget - coalesce(sum(cap) over ({part} {order} rows between unbounded preceding and 1 preceding), 0)) * w isfull from n{i})""")
        out.append(f"""o{i} as (select *, case when isfull then 0 else w end w_open,
  budget - sum(case when isfull then cap else 0 end) over ({part}) rest from f{i})""")
        out.append(f"""p{i} as (select *, sum(w_open) over ({part}) w_all,
  sum(w_open) over ({part} {order} rows between unbounded preceding and current row) w_upto from o{i})""")
        out.append(f"""g{i + 1} as (select {here}, cast(case when isfull then cap
  else rest * w_upto // w_all - rest * (w_upto - w_open) // w_all end as bigint) budget from p{i})""")
    ks = ", ".join(keys)
    out.append(f"""plan as (select *, case when tokens > 0 then budget // tokens else 0 end whole,
  case when tokens > 0 then budget % tokens else 0 end part from leaves join g{n} using ({ks}))""")
    out.append(f"""keyed as (select r.*, p.whole, p.part,
  md5('{seed}|' || p.whole || '|' || coalesce(cast(doc_id as varchar), '')) ord from rows_ r
  join (select {ks}, whole, part from plan) p using ({ks}))""")
    out.append(f"""cum as (select *, sum(tokens) over (partition by {ks} order by ord) - sum(tokens) over (partition by {ks}, ord)
  before_ from keyed)""")
    out.append("""took as (select *, whole + case when before_ < part then 1 else 0 end times from cum)""")
    return (f"with {', '.join(out)} select doc_id, {ks}, tokens, cast(epoch as bigint) epoch from "
            "(select *, unnest(range(cast(times as bigint))) epoch from took where times > 0)")
