"""Theme identity: composite lists, alias statistics, connected names and codes, members and the review queue."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import with_code_idx
from ..functions.columns import REASON_HEAD, bracket_content, fold_name, names_related, strip_brackets


def split_composites(df: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Comma lists of names and codes, zipped; lists of unequal length drop (see bad_splits), code 0 is other (-1).

    A single pair is primary; of several that at the position of ``parents`` (id, pos), which then meets the rows by ``id``.
    """
    n, c = F.split("zs_name", ","), F.split("zscode", ",")
    df = df.where(F.size(n) == F.size(c))
    if parents is not None:
        df = df.join(parents.select("id", F.col("pos").alias("_parent")), "id", "left")
    primary = (F.size(n) == 1) if parents is None else (F.size(n) == 1) | F.coalesce(F.col("pos") == F.col("_parent"), F.lit(False))
    keep = [x for x in df.columns if x not in ("zs_name", "zscode", "_parent")]
    extra = ["_parent"] if parents is not None else []
    out = df.select(*keep, *extra, "zs_name", F.posexplode(F.arrays_zip(n.alias("name"), c.alias("code"))).alias("pos", "p"))
    via = F.when(F.size(n) == 1, "single").otherwise("split")
    return out.select(*keep, "pos", F.trim("p.name").alias("name"), F.when(F.trim("p.code") == "0", "-1").otherwise(F.trim("p.code")).alias("zcode"), primary.alias("is_primary"), via.alias("via"))


def bad_splits(df: DataFrame) -> DataFrame:
    """Rows whose lists of names and codes differ in length."""
    return df.where(F.size(F.split("zs_name", ",")) != F.size(F.split("zscode", ",")))


def alias_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("name", "zcode").agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))


def pick_parent(df: DataFrame, segments: DataFrame, row_map: DataFrame | None = None) -> DataFrame:
    """Which of a composite row's names is its parent: (id, pos, parent, tier); no hit gives pos -1.

    ``df``: id, names, reason, segment. In turn: a name equals the segment; without brackets, or by their content, it does;
    the reason begins with "parent(segment)"; the segment's parent of ``segments`` (segment, parent), or without one that of the row
    in ``row_map`` (id, parent). Names are compared folded; within a tier the first position counts.
    """
    seg = segments.select(fold_name(F.col("segment")).alias("_s"), fold_name(F.col("parent")).alias("_p")).where("_p <> ''").groupBy("_s").agg(F.min("_p").alias("_p"))
    s = fold_name(F.col("segment"))
    d = df.withColumn("_seg", F.when((s != "") & (s != "nan"), s)).join(seg, F.col("_seg") == F.col("_s"), "left")
    if row_map is not None:
        d = d.join(row_map.select("id", fold_name(F.col("parent")).alias("_row")), "id", "left").withColumn("_p", F.coalesce("_p", F.when(F.col("_row") != "", F.col("_row"))))
    reason = F.coalesce("reason", F.lit(""))
    head = F.when(fold_name(F.regexp_extract(reason, REASON_HEAD, 2)) == F.col("_seg"), fold_name(F.regexp_extract(reason, REASON_HEAD, 1)))
    rows = d.select("id", "_seg", "_p", head.alias("_head"), F.posexplode("names").alias("pos", "name"))
    name, bare = fold_name(F.col("name")), fold_name(strip_brackets(F.col("name")))

    def is_name(c: str):
        return (name == F.col(c)) | (bare == F.col(c))

    tier = F.when(name == F.col("_seg"), 1).when((bare == F.col("_seg")) | (fold_name(bracket_content(F.col("name"))) == F.col("_seg")), 2).when(is_name("_head"), 3).when(is_name("_p"), 4)
    best = rows.where("_seg is not null").withColumn("tier", tier).where("tier is not null").groupBy("id").agg(F.min(F.struct("tier", "pos", "name")).alias("b"))
    return df.select("id").join(best, "id", "left").select("id", F.coalesce("b.pos", F.lit(-1)).alias("pos"), F.col("b.name").alias("parent"), F.col("b.tier").alias("tier"))


def _scratch(spark: SparkSession) -> None:
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + f"/_components-{uuid.uuid4().hex}")


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of a graph with edges (a, b): the smallest node reachable; each round hooks labels to their smallest neighbour and contracts."""
    _scratch(edges.sparkSession)
    graph = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    label = graph.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    graph = graph.where("a <> b")
    for _ in range(most_rounds):
        if graph.isEmpty():
            return label
        hook = graph.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("p")).checkpoint()
        for _ in range(2):
            hook = hook.join(hook.select(F.col("x").alias("p"), F.col("p").alias("q")), "p").select("x", F.col("q").alias("p"))
        hook = hook.checkpoint()
        label = label.join(hook, F.col("component") == F.col("x"), "left").select("node", F.coalesce("p", "component").alias("component")).checkpoint()
        ends = graph.join(hook.select(F.col("x").alias("a"), F.col("p").alias("pa")), "a").join(hook.select(F.col("x").alias("b"), F.col("p").alias("pb")), "b")
        graph = ends.where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct().checkpoint()
    raise RuntimeError("components did not settle")


def lifetime_pairs(alias: DataFrame) -> DataFrame:
    """Names of one code that follow each other by first appearance."""
    life = alias.where("zcode <> '-1'").groupBy("zcode", "name").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    w = Window.partitionBy("zcode").orderBy("first", "name")
    nxt = life.select("zcode", "name", "last", F.lead("name").over(w).alias("next_name"), F.lead("first").over(w).alias("next_first"))
    return nxt.where("next_name is not null")


def resolve_entities(alias: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """(name, zcode) with an entity: one name is one entity; adjacent names of a code join if related, or by hand (zcode, name_a, name_b), where both pairs exist."""
    nodes = alias.select("name", "zcode").distinct()
    pairs = lifetime_pairs(alias)
    links = pairs.where(names_related(F.col("name"), F.col("next_name"))).select(F.col("name").alias("a"), F.col("next_name").alias("b"))
    if manual is not None:
        known = manual.join(nodes.withColumnRenamed("name", "name_a"), ["zcode", "name_a"], "left_semi").join(nodes.withColumnRenamed("name", "name_b"), ["zcode", "name_b"], "left_semi")
        links = links.unionByName(known.select(F.col("name_a").alias("a"), F.col("name_b").alias("b")))
    comp = connected(links.unionByName(nodes.select(F.col("name").alias("a"), F.col("name").alias("b"))))
    return nodes.join(comp, F.col("name") == F.col("node")).select("name", "zcode", F.col("component").alias("entity"))


def entity_rollup(alias: DataFrame, entities: DataFrame) -> DataFrame:
    """Per entity first and last day, distinct codes and names, rows, its anchor: the pair with the largest (last, n), and an id from 1 by (first, anchor code)."""
    d = alias.join(entities, ["name", "zcode"])
    top = F.max(F.struct("last", "n", "name", "zcode"))
    out = d.groupBy("entity").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.countDistinct("zcode").alias("n_codes"), F.countDistinct("name").alias("n_names"), F.sum("n").alias("n_rows"), top.alias("_top"))
    out = out.withColumns({"anchor": F.col("_top.name"), "anchor_code": F.col("_top.zcode")}).drop("_top")
    # numbers within a first day, after the numbers of the days before, so that no task orders all entities
    days = out.groupBy("first").agg(F.count("*").alias("_n"))
    days = days.select(F.col("first"), F.coalesce(F.sum("_n").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("first").orderBy("anchor_code", "entity"))
    return out.withColumn("_i", place).join(days, "first").withColumn("entity_id", F.col("_before") + F.col("_i")).drop("_i", "_before")


def member_table(events: DataFrame, entities: DataFrame, calendar: DataFrame | None = None, master: DataFrame | None = None) -> DataFrame:
    """(date, code, entity, is_primary, via) of split rows; with calendar and master (code, code_idx) also tdi and code_idx, -1 where unknown."""
    out = events.join(entities, ["name", "zcode"]).select("date", "code", "entity", "is_primary", "via").distinct()
    if calendar is not None:
        out = out.join(F.broadcast(calendar.select("date", "tdi")), "date", "left").withColumn("tdi", F.coalesce("tdi", F.lit(-1)))
    return with_code_idx(out, master) if master is not None else out


def review_queue(alias: DataFrame, entities: DataFrame, split: DataFrame | None = None, bad: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """What a person should look at, as (kind, key, val, note).

    code_reuse: names of one code that follow each other in different entities. code_overlap and name_overlap: names of one code, codes of one
    name, that follow each other and overlap in time. pair_unseen: pairs of ``split`` that no single row has. bad_split: rows of ``bad`` (date, code,
    zs_name, zscode). manual_miss: joins by hand (zcode, name_a, name_b) one of whose pairs does not exist.
    """

    def queued(df: DataFrame, kind: str, key, val, note) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), key.alias("key"), val.alias("val"), note.alias("note"))

    e = entities.select("name", "entity").distinct()
    p = lifetime_pairs(alias).join(e, "name").join(e.select(F.col("name").alias("next_name"), F.col("entity").alias("next_entity")), "next_name")
    w = Window.partitionBy("name").orderBy("first", "zcode")
    codes = alias.select("name", "zcode", "last", F.lead("zcode").over(w).alias("next_code"), F.lead("first").over(w).alias("next_first"))
    parts = [
        queued(p.where("entity <> next_entity"), "code_reuse", F.col("zcode"), F.col("name"), F.col("next_name")),
        queued(p.where("next_first <= last"), "code_overlap", F.col("zcode"), F.col("name"), F.col("next_name")),
        queued(codes.where("next_first <= last"), "name_overlap", F.col("name"), F.col("zcode"), F.col("next_code")),
    ]
    if split is not None:
        pairs = split.where("via = 'split'").select("name", "zcode").distinct().join(split.where("via = 'single'").select("name", "zcode").distinct(), ["name", "zcode"], "left_anti")
        parts.append(queued(pairs, "pair_unseen", F.concat_ws("|", "name", "zcode"), F.lit(""), F.lit("")))
    if bad is not None:
        parts.append(queued(bad, "bad_split", F.concat_ws("|", "date", "code"), F.col("zscode"), F.col("zs_name")))
    if manual is not None:
        known = alias.select("name", "zcode").distinct()
        miss = manual.select("zcode", "name_a", "name_b", F.explode(F.array("name_a", "name_b")).alias("name")).join(known, ["name", "zcode"], "left_anti")
        parts.append(queued(miss, "manual_miss", F.concat_ws("|", "zcode", "name_a", "name_b"), F.lit(""), F.lit("")))
    return functools.reduce(DataFrame.unionByName, parts).distinct()
