"""Co-authorship network: weighted organisation pairs, their nodes and the display payload."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from citeloom.functions.scalars import n_choose_2, pair_sorted, settled
from citeloom.operators.grouping import attach_group, distinct_on_key, sample_keys
from citeloom.operators.joins import join_split, keep_keys_of, union_distinct_keys
from citeloom.session import stage


def team_sizes(affiliation: DataFrame, record: str = "lens_id") -> DataFrame:
    """(record, nb_authors) counted from the listed contributions, for data that states no number."""
    known = affiliation.where(F.col(record).isNotNull())
    return known.groupBy(record).agg(F.count_distinct("contribution_id").alias("nb_authors"))


def small_teams(affiliation: DataFrame, records: DataFrame, record: str, max_team_size: int | None) -> DataFrame:
    """Rows of the records with at most that many authors.

    The team size is part of the definition of a collaboration. It is the record's own number
    of authors (``nb_authors``), as lists of authors are cut by the source; records without
    it are left out. ``None`` is no bound, and then only the record has to be known.
    """
    known = affiliation.where(F.col(record).isNotNull())
    return join_split(known, records_within(records, record, max_team_size), [record], "left_semi")


def records_within(records: DataFrame, record: str, max_team_size: int | None) -> DataFrame:
    """The known records within the bound, once each."""
    within = records if max_team_size is None else records.where(F.col("nb_authors") <= max_team_size)
    return within.select(record).where(F.col(record).isNotNull()).distinct()


def left_out(records: DataFrame, max_team_size: int) -> DataFrame:
    """One row: how many records the bound leaves out, with those of unknown size."""
    within = F.coalesce(F.col("nb_authors") <= max_team_size, F.lit(False))
    return records.agg(F.count_if(~within).alias("nb_left_out"), F.count(F.lit(1)).alias("nb_records"))


#: A record of more lines than this is paired by a join that splits, not inside a row.
CROWD_LINES = 64
#: Rows of teams in a file; a scan puts few files together, and a task adds up the pairs of all its rows in memory.
TEAMS_PER_FILE = 65_536


class Teams(NamedTuple):
    """Lines of teams with a known ``unit``: one row per key with its ``lines``, and the lines of crowded keys."""

    rows: DataFrame
    crowd: DataFrame | None
    unit: str


def gather_teams(teams: DataFrame, keys: Sequence[str], unit: str) -> Teams:
    """Collect the lines (contribution and ``unit``) of every key in a row.

    A row holds at most ``CROWD_LINES`` lines. Keys of more lines, if there are any, keep their lines as rows.
    """
    rows, crowd = _gathered(teams, keys, unit)
    return Teams(stage(rows, "teams", TEAMS_PER_FILE), stage(crowd, "crowd") if crowd is not None else None, unit)


def _gathered(teams: DataFrame, keys: Sequence[str], unit: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows and crowd of ``gather_teams``, not staged yet."""
    links = teams.where(F.col(unit).isNotNull()).select(*keys, F.col("contribution_id").alias("author"), F.col(unit).alias("unit"))
    sizes = links.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    crowded = stage(sizes.where(F.col("_n") > CROWD_LINES).drop("_n"), "crowded")
    few, crowd = links, None
    if not crowded.isEmpty():
        few = join_split(links, crowded, keys, "left_anti")
        crowd = join_split(links, crowded, keys, "left_semi").select(*keys, F.col("author").alias("contribution_id"), F.col("unit").alias(unit))
    return few.groupBy(*keys).agg(F.collect_list(F.struct("author", "unit")).alias("lines")), crowd


def gather_small_teams(
    affiliation: DataFrame, records: DataFrame, record: str, unit: str, max_team_size: int | None
) -> Teams:
    """The same teams as of ``small_teams``, gathered before the bound is applied.

    A gathered row stands for all lines of its record and lies where they were grouped, so that
    finding the records within the bound neither moves nor sorts the lines once more. ``affiliation`` is
    read twice: stage it first where that is dear.
    """
    within = records_within(records, record, max_team_size)
    rows, crowd = _gathered(affiliation.where(F.col(record).isNotNull()), [record], unit)
    # One row per record on both sides: no key is hot, and both are dealt out by the record already.
    rows = stage(rows.join(within, record, "left_semi"), "teams", TEAMS_PER_FILE)
    return Teams(rows, stage(join_split(crowd, within, [record], "left_semi"), "crowd") if crowd is not None else None, unit)


def _weighed(left: Column, right: Column, pairs: Column) -> Column:
    """A pair of organisation sets that stands for ``pairs`` author pairs.

    Of the k x m organisation combinations of two sets with s shared ones, k*m - C(s,2) are
    distinct as unordered pairs, and each combination weighs that number.
    """
    shared = F.array_intersect(left, right)
    combined = F.size(left).cast("double") * F.size(right).cast("double")
    n = F.size(shared)
    return F.struct(
        left.alias("left"), right.alias("right"), shared.alias("shared"), (n == 0).alias("is_ext"),
        (pairs * (combined - n_choose_2(n))).alias("weight"), F.when(n == 0, combined).otherwise(n.cast("double")).alias("rows"),
    )


def _row_pairs(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Pairs of the organisation sets of each row's authors, scaled to 1 in total.

    Where every author has one organisation, or every organisation one author, the pairs are those of lines of
    two authors: lines of authors with k and m organisations, none of them shared, weigh k*m before the scaling.
    Elsewhere authors with the same organisations are one set with a multiplicity.
    """
    several = rows.select(*by, F.array_distinct("lines").alias("lines")).where(F.size("lines") > 1)
    lines, n = F.col("lines"), F.size("lines")
    plain = F.size(F.array_distinct(lines["author"])) == n
    apart = F.size(F.array_distinct(lines["unit"])) == n

    def own(x: Column) -> Column:
        """Organisations of the author of a line."""
        return F.size(F.filter("lines", lambda y: y["author"].eqNullSafe(x["author"]))).cast("double")

    def line(k: Column) -> Column:
        return F.transform("lines", lambda x: F.struct(x["author"].alias("author"), x["unit"].alias("unit"), k(x).alias("k")))

    # Of all pairs of lines, (k*m)^2 for every pair of authors: half of (sum of k^2)^2 less the sum of k^4, over authors.
    squares = F.aggregate("_lines", F.lit(0.0), lambda acc, x: acc + x["k"])
    fourths = F.aggregate("_lines", F.lit(0.0), lambda acc, x: acc + x["k"] * x["k"] * x["k"])
    total = F.when(F.col("_plain"), n_choose_2(F.size("_lines"))).otherwise((squares * squares - fourths) / F.lit(2.0))
    weighed = several.where(plain | apart).select(
        *by, plain.alias("_plain"), F.when(plain, line(lambda x: F.lit(1.0))).otherwise(line(own)).alias("_lines")
    )
    first = weighed.select(*by, "_lines", total.alias("_total"), F.size("_lines").alias("_n"), F.posexplode_outer("_lines").alias("_at", "_a"))
    both = first.where(F.col("_at") < F.col("_n") - 1).select(
        *by, "_total", "_a", F.explode_outer(F.slice("_lines", F.col("_at") + 2, F.col("_n"))).alias("_b")
    )
    left, right, external = F.array("_a.unit"), F.array("_b.unit"), F.col("_a.unit") != F.col("_b.unit")
    single = both.where(~F.col("_a.author").eqNullSafe(F.col("_b.author"))).select(
        *by, left.alias("left"), right.alias("right"), F.when(external, F.slice(left, 1, 0)).otherwise(left).alias("shared"),
        external.alias("is_ext"), (F.col("_a.k") * F.col("_b.k") / F.col("_total")).alias("row_weight"),
    )
    return single.unionByName(_set_pairs(several.where(~(plain | apart)), by))


def _set_pairs(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    lines = F.col("lines")
    authors = F.transform(
        F.array_distinct(lines["author"]),
        lambda a: F.sort_array(F.array_distinct(F.filter(lines, lambda x: x["author"].eqNullSafe(a))["unit"])),
    )
    sets = F.transform(
        F.array_distinct("_authors"),
        lambda s: F.struct(s.alias("orgs"), F.size(F.filter("_authors", lambda x: x == s)).cast("double").alias("n")),
    )

    def with_later(a: Column, i: Column) -> Column:
        """The set with itself and those behind it."""
        later = F.slice("_sets", i + 1, F.size("_sets"))
        return F.transform(
            later, lambda b, j: _weighed(a["orgs"], b["orgs"], F.when(j == 0, n_choose_2(a["n"])).otherwise(a["n"] * b["n"]))
        )

    pairs = F.filter(F.flatten(F.transform("_sets", with_later)), lambda p: p["weight"] > 0)
    total = F.aggregate("_pairs", F.lit(0.0), lambda acc, p: acc + p["weight"] * p["rows"])
    made = rows.withColumn("_authors", authors).withColumn("_sets", sets).withColumn("_pairs", pairs).withColumn("_total", total)
    # The outer form, as for the plain one the planner would make the pairs a second time, in a filter.
    each = made.select(*by, "_total", F.explode_outer("_pairs").alias("p")).where(F.col("p").isNotNull())
    return each.select(*by, "p.left", "p.right", "p.shared", "p.is_ext", (F.col("p.weight") / F.col("_total")).alias("row_weight"))


def _joined_pairs(teams: DataFrame, keys: Sequence[str], by: Sequence[str], unit: str) -> DataFrame:
    """The same for keys of any number of lines: sets of a record are rows, which the join splits."""
    authors = teams.groupBy(*keys, "contribution_id").agg(F.sort_array(F.collect_set(unit)).alias("orgs"))
    sets = authors.groupBy(*keys, "orgs").agg(F.count(F.lit(1)).cast("double").alias("authors"))
    a = sets.select(*keys, F.col("orgs").alias("left"), F.col("authors").alias("m"))
    b = sets.select(*keys, F.col("orgs").alias("right"), F.col("authors").alias("n"))
    both = join_split(a, b, keys).where(F.col("left") <= F.col("right"))
    pairs = F.when(F.col("left") == F.col("right"), n_choose_2(F.col("m"))).otherwise(F.col("m") * F.col("n"))
    weighed = both.select(*keys, _weighed(F.col("left"), F.col("right"), pairs).alias("p")).select(*keys, "p.*").where(F.col("weight") > 0)
    return attach_group(stage(weighed, "pairs"), keys, F.sum(F.col("weight") * F.col("rows")).alias("_total")).select(
        *by, "left", "right", "shared", "is_ext", (F.col("weight") / F.col("_total")).alias("row_weight")
    )


def edges_of_teams(teams: DataFrame | Teams, record: str = "lens_id", level: str = "org_id", by: Sequence[str] = ()) -> DataFrame:
    """Edges (from, to, is_ext, weight) between the organisations of teams, or between their countries.

    Every pair of authors of a record is external when they share no organisation. External
    pairs add all combinations of their organisations, other pairs only the organisations
    they share. Rows weigh C(n,2) x distinct pairs, then each record is scaled to 1 in
    total; C(n,2) is the same for all rows of a record and cancels there. The scale is known
    before any organisation pair is made. With ``by`` every value of these columns has a network of its own.

    Sets of organisations are paired instead of authors: all author pairs with the same two sets yield
    the same rows. Authors without a known organisation take part in no pair.
    """
    keys = [*by, record]
    gathered = teams if isinstance(teams, Teams) else gather_teams(teams, keys, level)
    scaled = _row_pairs(gathered.rows, by)
    if gathered.crowd is not None:
        scaled = scaled.unionByName(_joined_pairs(gathered.crowd, keys, by, gathered.unit))
    one_end = scaled.select(
        *by, "is_ext", "row_weight", "right",
        F.explode(F.when(F.col("is_ext"), F.col("left")).otherwise(F.col("shared"))).alias("_l"),
    )
    both_ends = one_end.select(
        *by, "is_ext", "row_weight", "_l",
        F.explode(F.when(F.col("is_ext"), F.col("right")).otherwise(F.array("_l"))).alias("_r"),
    )
    low, high = pair_sorted("_l", "_r")
    return both_ends.groupBy(*by, low.alias("from"), high.alias("to"), "is_ext").agg(settled(F.sum("row_weight")).alias("weight"))


def collaboration_edges(
    affiliation: DataFrame, records: DataFrame, max_team_size: int | None, record: str = "lens_id",
    sample: int | None = None, level: str = "org_id", seed: int = 42,
) -> DataFrame:
    """Edges of the network of all records up to a team size, or of a sample of records."""
    base = affiliation if sample is None else sample_keys(affiliation, record, sample, seed)
    lines = small_teams(base, records, record, max_team_size).select(record, "contribution_id", level)
    return edges_of_teams(stage(lines, "lines"), record, level)


def figures_of_teams(teams: DataFrame | Teams, record: str = "lens_id", by: Sequence[str] = ()) -> DataFrame:
    """Fractional contributions and number of records per organisation."""
    keys = [*by, record]
    gathered = teams if isinstance(teams, Teams) else gather_teams(teams, keys, "org_id")
    units = F.transform("lines", lambda x: x["unit"])
    counted = F.transform(
        F.array_distinct("_units"),
        lambda u: F.struct(u.alias("org_id"), (F.size(F.filter("_units", lambda x: x == u)) / F.size("_units")).alias("_part")),
    )
    parts = gathered.rows.select(*by, units.alias("_units")).select(*by, F.inline_outer(counted))
    if gathered.crowd is not None:
        cells = gathered.crowd.groupBy(*keys, "org_id").agg(F.count(F.lit(1)).alias("_rows"))
        spread = attach_group(cells, keys, F.sum("_rows").alias("_all"))
        parts = parts.unionByName(spread.select(*by, "org_id", (F.col("_rows") / F.col("_all")).alias("_part")))
    return parts.groupBy(*by, "org_id").agg(
        settled(F.sum("_part")).alias("nb_contributions"), F.count(F.lit(1)).alias("nb_records")
    )


def nodes_of_teams(teams: DataFrame | Teams, edges: DataFrame, organisations: DataFrame, record: str = "lens_id") -> DataFrame:
    """Nodes of the network: the organisations at the ends of edges, with their figures."""
    seen = join_split(union_distinct_keys(edges), figures_of_teams(teams, record), ["org_id"])
    return join_split(seen, organisations, ["org_id"])


def collaboration_nodes(
    affiliation: DataFrame, records: DataFrame, edges: DataFrame, organisations: DataFrame,
    max_team_size: int | None, record: str = "lens_id",
) -> DataFrame:
    return nodes_of_teams(small_teams(affiliation, records, record, max_team_size), edges, organisations, record)


def collaboration_network(
    affiliation: DataFrame, records: DataFrame, organisations: DataFrame, max_team_size: int | None,
    record: str = "lens_id", sample: int | None = None, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes) of the organisation network; the small teams are sought out once."""
    base = affiliation if sample is None else sample_keys(affiliation, record, sample, seed)
    teams = gather_small_teams(base, records, record, "org_id", max_team_size)
    edges = stage(edges_of_teams(teams, record), "edges")
    return edges, nodes_of_teams(teams, edges, organisations, record)


def collaboration_intervals(
    affiliation: DataFrame, records: DataFrame, organisations: DataFrame, spans: Sequence[tuple[int, int]], n: int,
    max_team_size: int | None, record: str = "lens_id",
) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes) per span of years: the n largest organisations and the edges among them.

    Spans include both their years, are told apart by ``first_year`` and ``last_year`` and may overlap. Largest
    means most fractional contributions in the span, ties to the smaller id; only organisations with an edge count.
    An extension: the original declares interval and number of nodes without using them.
    """
    by = ["first_year", "last_year"]
    listed = F.array(*[F.struct(F.lit(a).alias("first_year"), F.lit(b).alias("last_year")) for a, b in spans])
    within = F.filter(listed, lambda s: F.col("year_published").between(s["first_year"], s["last_year"]))
    dated = records.where(F.col("year_published").isNotNull()).select(record, F.inline(within))
    teams = small_teams(affiliation, records, record, max_team_size).select(record, "contribution_id", "org_id")
    teams = gather_teams(stage(join_split(teams, dated, [record]), "lines"), [*by, record], "org_id")
    edges = stage(edges_of_teams(teams, record, by=by), "edges")
    ends = edges.select(*by, F.col("from").alias("org_id")).unionByName(edges.select(*by, F.col("to").alias("org_id"))).distinct()
    figures = join_split(ends, figures_of_teams(teams, record, by), [*by, "org_id"])
    order = W.partitionBy(*by).orderBy(F.col("nb_contributions").desc(), "org_id")
    largest = stage(figures.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n), "largest")
    for end in ("from", "to"):
        edges = join_split(edges, largest.select(*by, F.col("org_id").alias(end)), [*by, end], "left_semi")
    return edges, join_split(largest, organisations, ["org_id"])


def edge_lines(edges: DataFrame, locations: DataFrame) -> DataFrame:
    """Edges with the coordinates of both ends.

    An organisation with several places is drawn at the one of the smallest ``geonames_id``. Edges with
    an end that has no place are left out.
    """
    known = locations.where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    places = distinct_on_key(known.select("org_id", "geonames_id", "lat", "lng"), ["org_id"], ["geonames_id", "lat", "lng"])

    def end(c: str, k: int) -> DataFrame:
        return places.select(F.col("org_id").alias(c), F.col("lat").alias(f"lat_{k}"), F.col("lng").alias(f"lng_{k}"))

    return join_split(join_split(edges, end("from", 1), ["from"]), end("to", 2), ["to"])


#: Organisations that are paired first to learn how many records the n best pairs have.
SEEDS = 256


def joint_records(present: DataFrame, sizes: DataFrame, worst: Row | None, least: int, record: str) -> DataFrame:
    """Joint records of all pairs that can still be among the best, out of organisations with ``least`` records.

    A pair has at most as many joint records as its smaller organisation has records. ``worst`` is
    the last of the best pairs so far: a pair whose bound equals its count has to stand before it.
    """
    wanted = sizes.where(F.col("n") >= least).select("org_id", "n")
    rows = join_split(present, wanted, ["org_id"])
    first, second = rows.select(record, F.col("org_id").alias("from"), F.col("n").alias("n_from")), rows.select(record, F.col("org_id").alias("to"), F.col("n").alias("n_to"))
    before = F.col("from") < F.col("to")
    if worst is not None:
        first = first.where((F.col("n_from") > worst.nb_records) | (F.col("from") <= worst["from"]))
        above = F.least("n_from", "n_to") > worst.nb_records
        before &= above | (F.col("from") < worst["from"]) | ((F.col("from") == worst["from"]) & (F.col("to") <= worst["to"]))
    together = join_split(first, second, [record]).where(before)
    return together.groupBy("from", "to").agg(F.count(F.lit(1)).alias("nb_records"))


def top_pairs_unweighted(
    affiliation: DataFrame, records: DataFrame, n: int, max_team_size: int | None, record: str = "lens_id"
) -> DataFrame:
    """The n organisation pairs that appear together on most records, ties to the smaller ids.

    Exact, and without pairing all organisations of a record: organisations with fewer records than the
    n-th best pair found so far cannot be in a better pair. The ``SEEDS`` largest are paired first, then
    those above a falling number of records, until no smaller organisation can matter.
    """
    teams = small_teams(affiliation, records, record, max_team_size).where(F.col("org_id").isNotNull())
    present = stage(teams.select(record, "org_id").distinct(), "present")
    sizes = stage(present.groupBy("org_id").agg(F.count(F.lit(1)).alias("n")), "sizes")
    order = [F.col("nb_records").desc(), "from", "to"]

    def best(counts: DataFrame) -> tuple[DataFrame, Row | None]:
        top = stage(counts.orderBy(*order).limit(n), "pairs")
        rows = top.orderBy(*order).collect()  # n rows, as many as the caller asks for
        return top, rows[-1] if len(rows) == n else None

    seeds = stage(sizes.orderBy(F.col("n").desc(), "org_id").limit(max(SEEDS, 2 * math.isqrt(n) + 2)), "seeds")
    top, worst = best(joint_records(present, seeds, None, 1, record))
    least = seeds.agg(F.min("n")).first()[0] or 1
    done = None
    while True:
        least = max(1, least // 4, worst.nb_records if worst else 1)
        # Nothing to pair anew where no organisation has so few records.
        if done is None or not sizes.where((F.col("n") >= least) & (F.col("n") < done)).isEmpty():
            top, worst = best(joint_records(present, sizes, worst, least, record))
        done = least
        if least <= (worst.nb_records if worst else 1):
            return top


def graph_vertices(nodes: DataFrame, edges: DataFrame, group: str = "country_code") -> DataFrame:
    """Nodes that occur in an edge: id, label and colour group."""
    seen = keep_keys_of(nodes, "org_id", union_distinct_keys(edges), "org_id")
    return seen.select(F.col("org_id").alias("id"), F.col("name").alias("label"), F.col(group).alias("group"))


def graph_edges(edges: DataFrame) -> DataFrame:
    """Edges with their width and the width range of the whole graph."""
    low, high = edges.agg(F.min("weight")).scalar(), edges.agg(F.max("weight")).scalar()
    return edges.select("from", "to", F.col("weight").alias("width"), low.alias("min_width"), high.alias("max_width"))
