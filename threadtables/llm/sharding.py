"""Shards of near equal bytes by a k-d tree over document metadata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from threadtables.llm.ranks import group_slots
from threadtables.session import stage

#: Buckets of one histogram pass over a node: what the driver gets is this many counts for each open node at most.
FANOUT = 4096
_BITS = 62


@dataclass
class _Node:
    first: int  # of its leaves
    leaves: int
    cut: tuple[str, int] | None = None  # rows below the position go left
    sides: tuple[_Node, _Node] | None = None

    def label(self) -> Column:
        """The first leaf of the deepest node so far that a row belongs to."""
        if self.sides is None:
            return F.lit(self.first)
        return F.when(F.col(self.cut[0]) < F.lit(self.cut[1]), self.sides[0].label()).otherwise(self.sides[1].label())


def _scaled(value: Column, low: float, high: float) -> Column:
    """A value as 30 bits, or all equal."""
    span = float(high) - float(low)
    return F.floor((value - F.lit(float(low))) / F.lit(span or 1.0) * F.lit(float(2**30 - 1))).cast("long")


def kd_shards(docs: DataFrame, shards: int, dims: dict[str, Column], weight: Column, tie: Column,
              tolerance: float = 1e-4) -> DataFrame:
    """`docs` with a column `shard`: leaves of a k-d tree, each with about the same sum of `weight`.

    Each node takes the dimension along which its rows spread most (all scaled to the corpus's range) and splits it at
    the weighted quantile that its number of leaves asks for: the median where it is even. The quantile comes from
    histograms over all rows, narrowed until the bucket of the cut holds under `tolerance` of a leaf or a single
    position. Equal values are told apart by `tie`, so a hot value is split like any other. A null dimension counts as
    the lowest value; a null weight as 0. Rows equal in all of it stay together.
    """
    names = list(dims)
    raw = docs.select("*", F.coalesce(weight.cast("long"), F.lit(0)).alias("_w"),
                      F.pmod(F.xxhash64(tie), F.lit(2**32)).alias("_tie"),
                      *(c.cast("double").alias(f"_d{i}") for i, c in enumerate(dims.values())))
    raw = stage(raw, "kd-rows")
    ends = raw.agg(F.sum("_w").alias("w"), *(f(f"_d{i}").alias(f"{n}{i}") for i in range(len(names)) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    lows = [ends[f"lo{i}"] if ends[f"lo{i}"] is not None else 0.0 for i in range(len(names))]
    highs = [ends[f"hi{i}"] if ends[f"hi{i}"] is not None else 0.0 for i in range(len(names))]
    pos = [F.shiftleft(F.coalesce(_scaled(F.col(f"_d{i}"), lows[i], highs[i]), F.lit(0)), 32).bitwiseOR(F.col("_tie")) for i in range(len(names))]
    rows = stage(raw.select(*docs.columns, "_w", *(p.alias(f"_p{i}") for i, p in enumerate(pos))), "kd-places")
    leaf = (ends["w"] or 0) / shards
    root = _Node(0, shards)
    level = [root]
    while open_nodes := {n.first: n for n in level if n.leaves > 1}:
        at = rows.withColumn("_node", root.label()).where(F.col("_node").isin(*open_nodes))
        _place_cuts(at, open_nodes, len(names), leaf * tolerance)
        for n in open_nodes.values():
            half = n.leaves // 2
            n.sides = (_Node(n.first, half), _Node(n.first + half, n.leaves - half))
        level = [side for n in open_nodes.values() for side in n.sides]
    return rows.select(*docs.columns, root.label().alias("shard"))


def _place_cuts(at: DataFrame, nodes: dict[int, _Node], dims: int, tolerance: float) -> None:
    """Choose the widest dimension of every open node and find its cut; each pass reads the rows once for all nodes."""
    spans = at.groupBy("_node").agg(F.sum("_w").alias("w"), *(f(f"_p{i}").alias(f"{n}{i}") for i in range(dims) for n, f in (("lo", F.min), ("hi", F.max)))).collect()
    seen = {r["_node"]: r for r in spans}
    todo: dict[int, dict] = {}
    for key, node in nodes.items():
        if key not in seen:
            node.cut = ("_p0", 0)
            continue
        r = seen[key]
        wide = max(range(dims), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
        todo[key] = {"dim": f"_p{wide}", "lo": r[f"lo{wide}"], "hi": r[f"hi{wide}"] + 1, "below": 0,
                     "goal": r["w"] * (node.leaves // 2) / node.leaves}
    while todo:
        value = bucket = None
        for key, t in todo.items():
            step = t["step"] = -(-(t["hi"] - t["lo"]) // FANOUT)
            p = t["dim"]
            here = F.expr(f"case when {p} >= {t['lo']} and {p} < {t['hi']} then int(({p} - {t['lo']}) div {step}) end")
            bucket = F.when(F.col("_node") == key, here) if bucket is None else bucket.when(F.col("_node") == key, here)
        counts = at.where(F.col("_node").isin(*todo)).select("_node", "_w", bucket.alias("_b")).where("_b is not null").groupBy("_node", "_b").agg(F.sum("_w").alias("w")).collect()
        by: dict[int, dict[int, int]] = {}
        for r in counts:
            by.setdefault(r["_node"], {})[r["_b"]] = r["w"]
        for key in list(todo):
            t, below = todo[key], todo[key]["below"]
            for b in sorted(by.get(key, {})):
                w = by[key][b]
                if below + w >= t["goal"]:
                    break
                below += w
            lo = t["lo"] + b * t["step"]
            if t["step"] == 1 or w <= tolerance:
                nearer = below + w - t["goal"] < t["goal"] - below
                nodes[key].cut = (t["dim"], min(lo + t["step"], t["hi"]) if nearer else lo)
                del todo[key]
            else:
                t.update(lo=lo, hi=min(lo + t["step"], t["hi"]), below=below)


def document_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: all documents in shards of near equal bytes.

    Size is the UTF-8 bytes of the text (null: none) plus 8. Dimensions: size, doc_id, language and source (as hashes
    of their names). A null text has size 8 and a null checksum; repeated rows are kept; other columns are ignored.
    """
    meta = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"), F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 8).alias("_size"),
        F.pmod(F.xxhash64("lang"), F.lit(1009)).alias("_lang"), F.pmod(F.xxhash64("source"), F.lit(1009)).alias("_source"))
    dims = {"size": F.col("_size"), "doc_id": F.col("doc_id"), "lang": F.col("_lang"), "source": F.col("_source")}
    tree = kd_shards(meta, shards, dims, F.col("size"), F.col("doc_id")).select("doc_id", "size", "text_crc32", "shard")
    return group_slots(tree, ["shard"], ["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
