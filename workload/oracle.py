"""SQL over the test tables that states what each registered query must return.

The statements share a few named blocks, put in front of a query as common table
expressions. They are written from the definitions, without looking at how the Spark jobs
get there: arrays, windows and all-pairs joins are fine here.
"""

from __future__ import annotations

LO, HI = 1996, 2000
TOTAL = "sum({0}) OVER ()"

# Sums of fractions are taken to 9 places, where the order of addition no longer shows.

# --- shared blocks ---------------------------------------------------------------------

TEAMS = "teams AS (SELECT l_orderkey AS lens_id, count(DISTINCT l_linenumber) AS nb_authors FROM lineitem GROUP BY 1)"

FACTS = """facts AS (
  SELECT o_orderkey AS lens_id, CAST(year(o_orderdate) AS BIGINT) AS year_published,
         o_orderpriority AS publication_type, o_custkey AS source_id,
         CAST(floor(o_totalprice / 1000) AS BIGINT) AS citations, o_orderstatus = 'P' AS is_retracted,
         o_orderdate AS date_published
  FROM orders)"""

RECORDS = f"{TEAMS}, {FACTS}, records AS (SELECT f.*, t.nb_authors FROM facts f LEFT JOIN teams t USING (lens_id))"
WINDOWED = f"{RECORDS}, recent AS (SELECT * FROM records WHERE year_published BETWEEN {LO} AND {HI})"

ORGS = """orgs AS (
  SELECT s_suppkey AS org_id, s_name AS name,
         CASE WHEN s_nationkey = 0 THEN '??' ELSE 'N' || s_nationkey END AS country_code
  FROM supplier)"""

COUNTRIES = """countries AS (
  SELECT 'N' || n_nationkey AS country_code, n_name AS country, 'State of ' || n_name AS admin
  FROM nation WHERE n_nationkey BETWEEN 1 AND 23)"""

FUNDING = """funding AS (
  SELECT l_orderkey AS lens_id, nullif(p_brand, 'Brand#1') AS org,
         CASE WHEN p_size > 1 THEN CAST(l_partkey AS VARCHAR) END AS funding_id,
         nullif(p_type, 'PROMO') AS country
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

FUNDED = f"""{RECORDS}, {FUNDING},
lines AS (
  SELECT DISTINCT lens_id, org, country,
         CASE WHEN funding_id IS NULL AND org IS NOT NULL THEN 'Unknown' ELSE funding_id END AS funding_id
  FROM funding),
joined AS (
  SELECT r.lens_id, r.nb_authors, r.year_published, l.org, l.country, l.funding_id,
         count(*) OVER (PARTITION BY r.lens_id) AS n
  FROM records r LEFT JOIN lines l USING (lens_id)),
kept AS (
  SELECT *, count(*) OVER (PARTITION BY lens_id) AS k FROM joined WHERE NOT (n > 1 AND org IS NULL)),
grouped AS (
  SELECT org, country, round(sum(1.0::DOUBLE / k), 9) AS nb_records, count(DISTINCT funding_id) AS nb_projects,
         round(avg(nb_authors), 1) AS avg_nb_authors, round(median(nb_authors), 1) AS median_nb_authors,
         round(avg(year_published), 1) AS avg_year
  FROM kept GROUP BY org, country),
shares AS (
  SELECT *, nb_records / (SELECT sum(nb_records) FROM grouped) * 100 AS share_records,
         nb_projects / (SELECT sum(nb_projects) FROM grouped)::DOUBLE * 100 AS share_projects
  FROM grouped)"""

# Nodes left after the label corrections, levels 0 to 3.
NODES = """nodes AS (
  SELECT 'R' || r_regionkey AS id, 0 AS level, r_name AS raw FROM region
  UNION ALL SELECT 'N' || n_nationkey, 1, n_name FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 2, s_name FROM supplier WHERE s_suppkey NOT IN (3, 5, 8, 13)
  UNION ALL SELECT 'P' || p_partkey, 3, p_name || ' ' || p_partkey FROM part),
named AS (
  SELECT *, CASE id WHEN 'S1' THEN 'Supplier (first)' WHEN 'S2' THEN 'Supplier (second)' ELSE raw END AS label FROM nodes)"""

# Supplier -> nation -> region, for categories at level 2.
PLACES = """places AS (
  SELECT s_suppkey, s_name, 'N' || n_nationkey AS parent_1, n_name AS display_name_1,
         'R' || r_regionkey AS parent_0, r_name AS display_name_0
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey NOT IN (3, 5, 8, 13))"""

LINKED = f"""{PLACES},
cats AS (SELECT DISTINCT l_orderkey AS lens_id, l_suppkey, s_name AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
linked AS (
  SELECT c.lens_id, c.value AS raw_display_name, CASE WHEN p.s_suppkey IS NOT NULL THEN 'S' || p.s_suppkey END AS category_id,
         p.parent_1, p.parent_0, p.display_name_1, p.display_name_0,
         bool_and(p.s_suppkey IS NULL) OVER (PARTITION BY c.lens_id) AS is_not_linked
  FROM cats c LEFT JOIN places p ON c.value = p.s_name)"""

FLOWS = f"""{FACTS}, {LINKED},
recent_links AS (
  SELECT * FROM linked
  WHERE lens_id IN (SELECT lens_id FROM facts WHERE year_published BETWEEN {LO} AND {HI})),
cells AS (
  SELECT DISTINCT lens_id, parent_0, display_name_0, parent_1, display_name_1
  FROM recent_links WHERE category_id IS NOT NULL AND NOT is_not_linked),
weighed AS (SELECT *, count(*) OVER (PARTITION BY lens_id) AS k FROM cells),
leaves AS (
  SELECT parent_0, display_name_0, parent_1, display_name_1, round(sum(1.0::DOUBLE / k), 9) AS nb_1
  FROM weighed GROUP BY ALL),
domains AS (
  SELECT parent_0, round(sum(nb_1), 9) AS nb_0, percent_rank() OVER (ORDER BY round(sum(nb_1), 9)) AS percentile_0 FROM leaves GROUP BY 1),
disciplines AS (
  SELECT parent_1, percent_rank() OVER (ORDER BY round(sum(nb_1), 9)) AS percentile_1 FROM leaves GROUP BY 1),
ranked AS (SELECT * FROM leaves JOIN domains USING (parent_0) JOIN disciplines USING (parent_1)),
totals AS (
  SELECT count(DISTINCT lens_id) - count(DISTINCT CASE WHEN is_not_linked THEN lens_id END) AS n FROM recent_links)"""


def edges(org: str = "l_suppkey", lines: str = "lineitem", most: int = 20) -> str:
    """Weighted pairs, written pair by pair of contributions as they are defined."""
    return f"""authors AS (
  SELECT l_orderkey AS r, l_linenumber AS c, list_sort(list(DISTINCT {org})) AS orgs FROM {lines} GROUP BY 1, 2),
team AS (SELECT r, count(*) AS n FROM authors GROUP BY 1),
author_pairs AS (
  SELECT a.r, a.c AS c1, b.c AS c2, a.orgs AS f, b.orgs AS t, NOT list_has_any(a.orgs, b.orgs) AS is_ext, n
  FROM authors a JOIN authors b ON a.r = b.r AND a.c < b.c JOIN team ON team.r = a.r WHERE n <= {most}),
half AS (SELECT r, c1, c2, is_ext, n, unnest(f) AS x, t FROM author_pairs),
both_ends AS (SELECT r, c1, c2, is_ext, n, x, unnest(t) AS y FROM half),
pairs AS (SELECT r, c1, c2, is_ext, n, least(x, y) AS p, greatest(x, y) AS q FROM both_ends),
sizes AS (SELECT r, c1, c2, count(DISTINCT (p, q)) AS k FROM pairs GROUP BY 1, 2, 3),
rows_weighed AS (SELECT pairs.*, n * (n - 1) / 2.0::DOUBLE * k AS w FROM pairs JOIN sizes USING (r, c1, c2)),
per_record AS (
  SELECT r, p, q, is_ext, sum(w) AS w FROM rows_weighed WHERE is_ext OR p = q GROUP BY 1, 2, 3, 4),
scaled AS (SELECT *, w / sum(w) OVER (PARTITION BY r) AS s FROM per_record),
net AS (SELECT p AS "from", q AS "to", is_ext, round(sum(s), 9) AS weight FROM scaled GROUP BY 1, 2, 3)"""


SPANS = [(1995, 1997), (1997, 2000)]


def interval(first: int, last: int) -> str:
    """The network of one span of years and its 25 largest organisations."""
    return f"""WITH dated AS (
  SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN {first} AND {last})),
{edges("l_suppkey", "dated")},
small AS (SELECT l.l_orderkey AS r, l.l_suppkey AS org_id FROM dated l JOIN team ON team.r = l.l_orderkey WHERE n <= 20),
spread AS (SELECT r, org_id, count(*) OVER (PARTITION BY r) AS k FROM small),
sums AS (
  SELECT org_id, round(sum(1.0::DOUBLE / k), 9) AS nb_contributions, count(DISTINCT r) AS nb_records FROM spread
  WHERE org_id IN (SELECT "from" FROM net UNION SELECT "to" FROM net) GROUP BY 1),
largest AS (
  SELECT *, row_number() OVER (ORDER BY nb_contributions DESC, org_id) AS position FROM sums
  QUALIFY row_number() OVER (ORDER BY nb_contributions DESC, org_id) <= 25)"""


NET_NODES = f"""{ORGS},
small AS (SELECT l.l_orderkey AS r, l.l_suppkey AS org_id FROM lineitem l JOIN team ON team.r = l.l_orderkey WHERE n <= 20),
spread AS (SELECT r, org_id, count(*) OVER (PARTITION BY r) AS k FROM small),
sums AS (SELECT org_id, round(sum(1.0::DOUBLE / k), 9) AS nb_contributions, count(DISTINCT r) AS nb_records FROM spread GROUP BY 1),
net_nodes AS (
  SELECT s.*, o.name, o.country_code FROM sums s JOIN orgs o USING (org_id)
  WHERE org_id IN (SELECT "from" FROM net UNION SELECT "to" FROM net))"""

MAP = f"""{edges()}, {NET_NODES}, {COUNTRIES},
located AS (
  SELECT s_suppkey AS org_id, 'N' || s_nationkey AS country_code FROM supplier WHERE s_acctbal >= 0),
strong AS (SELECT * FROM net WHERE is_ext AND weight >= 1.0),
map_nodes AS (
  SELECT l.org_id, l.country_code, n.name, n.nb_records FROM located l JOIN net_nodes n USING (org_id)
  WHERE l.org_id IN (SELECT "from" FROM strong UNION SELECT "to" FROM strong)),
map_edges AS (
  SELECT * FROM strong WHERE "from" IN (SELECT org_id FROM map_nodes) AND "to" IN (SELECT org_id FROM map_nodes)),
map_countries AS (
  SELECT country_code, admin, count(*) AS nb_org FROM map_nodes JOIN countries USING (country_code) GROUP BY 1, 2)"""

TYPED = f"""{FACTS},
typed AS (
  SELECT lens_id, year_published AS year, publication_type, citations, is_retracted,
         CASE publication_type WHEN '1-URGENT' THEN 'ja' WHEN '2-HIGH' THEN 'ja' WHEN '3-MEDIUM' THEN 'cp'
              WHEN '4-NOT SPECIFIED' THEN 'pp' END AS pubtype_id
  FROM facts)"""

CELLS = f"""{TYPED}, {LINKED},
members AS (
  SELECT DISTINCT l.lens_id, l.parent_1, t.year, t.pubtype_id, t.citations
  FROM linked l JOIN typed t USING (lens_id)
  WHERE l.parent_1 IS NOT NULL AND NOT t.is_retracted AND t.pubtype_id IS NOT NULL)"""

PUBS = """pubs AS (
  SELECT 'P' || o_orderkey AS lens_id, o_orderkey, o_custkey, o_orderstatus AS st, o_orderdate, o_orderpriority,
         o_totalprice, CAST(quarter(o_orderdate) - 1 AS BIGINT) AS nb_authors, c_custkey, c_name, c_mktsegment, c_acctbal,
         c_nationkey, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

SOURCES = f"""{PUBS},
titled AS (
  SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN 'other' ELSE c_name END AS title,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'other' ELSE c_mktsegment END AS publisher_name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'other' ELSE 'journal' END AS type,
         CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal < 0 THEN 'other' ELSE n_name END AS country
  FROM pubs),
source AS (
  SELECT row_number() OVER (ORDER BY title, publisher_name, type, country) - 1 AS source_id, *
  FROM (SELECT DISTINCT title, publisher_name, type, country FROM titled))"""

AUTHORS = f"""{PUBS},
authors AS (
  SELECT p.*, i AS author_position FROM pubs p, (SELECT unnest([1, 2, 3]) AS i) WHERE i <= nb_authors
  UNION ALL SELECT p.*, 1 FROM pubs p WHERE nb_authors = 0),
contribution AS (SELECT *, lens_id || '#' || author_position AS contribution_id FROM authors)"""

AFFILIATIONS = f"""{AUTHORS},
own AS (
  SELECT contribution_id, 1 AS place, 'Org ' || c_custkey AS name,
         CASE WHEN st = 'F' THEN '??' ELSE 'N' || c_nationkey END AS country_code,
         CASE WHEN st = 'F' THEN '??' ELSE 'g' || c_custkey END AS grid_id, c_custkey, st
  FROM contribution WHERE nb_authors > 0 AND (author_position = 1 OR (author_position = 2 AND st <> 'P'))),
state AS (
  SELECT contribution_id, 2 AS place, 'State Org ' || c_nationkey AS name, 'N' || c_nationkey AS country_code,
         '??' AS grid_id, c_custkey, st
  FROM contribution WHERE nb_authors > 0 AND author_position = 2 AND st <> 'P'),
missing AS (
  SELECT contribution_id, 1 AS place, 'unknown' AS name, '??' AS country_code, '??' AS grid_id, c_custkey, st
  FROM contribution WHERE author_position = 3),
lines AS (SELECT * FROM own UNION ALL SELECT * FROM state UNION ALL SELECT * FROM missing),
org AS (
  SELECT row_number() OVER (ORDER BY name, country_code, grid_id) - 1 AS org_id, *
  FROM (SELECT DISTINCT name, country_code, grid_id FROM lines)),
org_ids AS (
  SELECT org_id, 'ror' AS type, 'ror:' || substr(name, 5) AS value FROM org WHERE name LIKE 'Org %'
  UNION ALL SELECT org_id, 'grid', grid_id FROM org WHERE name LIKE 'Org %' AND grid_id <> '??')"""

TOPICS = """topics AS (
  SELECT 'C' || c_custkey AS id, c_name, 'N' || n_nationkey || '-' || c_mktsegment AS sub, n_name || ' ' || c_mktsegment AS sub_name,
         'N' || n_nationkey AS fld, n_name AS fld_name, 'R' || r_regionkey AS dom, r_name AS dom_name, c_custkey, n_nationkey,
         c_mktsegment, r_regionkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
edges AS (
  SELECT DISTINCT fld AS child, dom AS parent FROM topics
  UNION SELECT DISTINCT sub, fld FROM topics UNION SELECT DISTINCT id, sub FROM topics),
topic_nodes AS (
  SELECT id AS category_id, 3::BIGINT AS level, c_name AS display_name, CAST(NULL AS VARCHAR) AS wikidata, 'wiki/' || c_name AS wikipedia,
         dom AS domain_id, fld AS field_id, sub AS subfield_id FROM topics
  UNION ALL SELECT DISTINCT dom, 0, dom_name, 'Q' || dom, 'wiki/' || dom_name, dom, NULL, NULL FROM topics
  UNION ALL SELECT DISTINCT fld, 1, fld_name, 'Q' || n_nationkey, 'wiki/' || fld_name, NULL, fld, NULL FROM topics WHERE n_nationkey <> 0
  UNION ALL SELECT DISTINCT sub, 2, sub_name, 'Q' || n_nationkey || c_mktsegment, 'wiki/' || c_mktsegment, NULL, NULL, sub FROM topics)"""

# The first topics bear the label of their nation, two levels above.
SHARED_TOPICS = TOPICS.replace("c_custkey AS id, c_name,", "c_custkey AS id, CASE WHEN c_custkey <= 40 THEN n_name ELSE c_name END AS c_name,")

# Nodes of the four-level taxonomy with their ancestors.
RESOLVED_TOPICS = """names AS (SELECT category_id, display_name FROM topic_nodes WHERE level < 3),
up AS (SELECT child, parent FROM edges WHERE parent IN (SELECT category_id FROM names)),
resolved AS (
  SELECT category_id, level, display_name, 'N/A' AS parent_2, 'N/A' AS parent_1, category_id AS parent_0 FROM topic_nodes WHERE level = 0
  UNION SELECT category_id, level, display_name, 'N/A', category_id, coalesce(parent, '0')
        FROM topic_nodes LEFT JOIN up ON child = category_id WHERE level = 1
  UNION SELECT category_id, level, display_name, category_id, coalesce(a.parent, '0'), coalesce(b.parent, '0')
        FROM topic_nodes LEFT JOIN up a ON a.child = category_id LEFT JOIN up b ON b.child = a.parent WHERE level = 2
  UNION SELECT category_id, level, display_name, subfield_id, field_id, domain_id FROM topic_nodes WHERE level = 3)"""

REGISTRY = "reg AS (SELECT customer.*, n_name, 'r' || c_custkey AS id FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def _bins(table: str, value: str, shift: int) -> str:
    """Legend bin of ``value``: number of sorted cut points passed, the last bin closed."""
    cuts = (
        f"list_sort([1.0::DOUBLE, ceil(m / 10.0::DOUBLE) + {shift}, ceil(m / 5.0::DOUBLE) + {shift},"
        f" ceil(m / 2.0::DOUBLE) + {shift}, m::DOUBLE])"
    )
    return f"""cut AS (SELECT {cuts} AS cuts FROM (SELECT max({value}) AS m FROM {table})),
binned AS (
  SELECT t.*, CASE WHEN {value} >= cuts[1] AND {value} <= cuts[5] THEN
    CAST(1 + ({value} >= cuts[2])::INT + ({value} >= cuts[3])::INT + ({value} >= cuts[4])::INT AS BIGINT) END AS bin
  FROM {table} t, cut)"""


#: Columns of every project table that its digest is made of.
PUBLICATION_DIGESTS = {
    "records_id": ["lens_id", "type", "value"],
    "source": ["source_id", "title", "publisher_name", "type", "country"],
    "source_issn": ["source_id", "type", "value"],
    "records": ["lens_id", "year_published", "is_open_access", "publication_type", "nb_authors", "scholarly_citations_count", "source_id"],
    "categories": ["lens_id", "value", "category_id", "qualifier", "qualifier_id", "type"],
    "contribution": ["contribution_id", "lens_id", "author_position", "first_name", "last_name", "nb_ids", "nb_affiliations"],
    "contributors_id": ["contribution_id", "type", "value"],
    "affiliation": ["affiliation_id", "contribution_id", "org_id"],
    "organisations": ["org_id", "name", "country_code", "nb_ids"],
    "organisations_id": ["org_id", "type", "value"],
    "funding": ["lens_id", "org", "funding_id", "country"],
    "locations": ["org_id", "id", "geonames_id", "name", "country_code", "country_name"],
    "categories_concepts": ["lens_id", "category_id", "parent_1", "parent_0", "is_not_linked"],
    "categories_topics": ["lens_id", "display_name", "category_id", "level", "parent_2", "parent_1", "parent_0", "is_not_linked"],
    "net_org_edges": ["from", "to", "is_ext"],
    "net_org_nodes": ["org_id", "nb_records", "name", "country_code"],
}


def _digest(name: str, sql: str, columns: list[str]) -> str:
    """Number of rows of a statement and the sum of 32-bit digests of its rows."""
    text = ", ".join(f"""coalesce(CAST("{c}" AS VARCHAR), '~')""" for c in columns)
    return f"""SELECT '{name}' AS name, count(*) AS nb_rows, CAST(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT) AS BIGINT) AS digest
FROM ({sql})"""


COUNTRY_REPORT = f"""{WINDOWED}, {ORGS}, {COUNTRIES},
chain AS (
  SELECT r.lens_id, r.nb_authors, r.year_published, o.country_code
  FROM recent r LEFT JOIN lineitem l ON l.l_orderkey = r.lens_id LEFT JOIN orgs o ON o.org_id = l.l_suppkey),
grouped AS (
  SELECT country_code, count(DISTINCT lens_id) AS nb_records, round(avg(nb_authors), 1) AS avg_nb_authors,
         round(median(nb_authors), 1) AS median_nb_authors, round(avg(year_published), 1) AS avg_year
  FROM chain GROUP BY 1),
clean AS (
  SELECT g.*, nb_records / (SELECT sum(nb_records) FROM grouped)::DOUBLE * 100 AS share_records FROM grouped g
  WHERE country_code IS NOT NULL AND avg_nb_authors IS NOT NULL)"""

TYPE_REPORT = f"""{WINDOWED},
grouped AS (
  SELECT publication_type, count(*) AS nb_records, round(avg(nb_authors), 1) AS avg_nb_authors,
         round(median(nb_authors), 1) AS median_nb_authors
  FROM recent GROUP BY 1),
types AS (
  SELECT *, nb_records / (SELECT sum(nb_records) FROM grouped)::DOUBLE * 100 AS share_records FROM grouped
  WHERE publication_type IS NOT NULL AND avg_nb_authors IS NOT NULL)"""

SOURCE_REPORT = f"""{WINDOWED},
grouped AS (
  SELECT c_name AS title, count(*) AS nb_records, round(avg(nb_authors), 1) AS avg_nb_authors,
         round(median(nb_authors), 1) AS median_nb_authors, round(avg(year_published), 1) AS avg_year
  FROM recent LEFT JOIN customer ON c_custkey = source_id GROUP BY 1),
titles AS (
  SELECT *, nb_records / (SELECT sum(nb_records) FROM grouped)::DOUBLE * 100 AS share_records FROM grouped
  WHERE title IS NOT NULL AND avg_nb_authors IS NOT NULL)"""

YEAR_REPORT = f"""{WINDOWED},
yearly AS (
  SELECT year_published, count(*) AS nb_records, round(avg(nb_authors), 1) AS avg_nb_authors,
         round(median(nb_authors), 1) AS median_nb_authors
  FROM recent GROUP BY 1 HAVING avg(nb_authors) IS NOT NULL)"""


def _even(c: str, digits: int) -> str:
    """Half-to-even rounding of a double."""
    return f"round_even({c}, {digits})::DOUBLE"


def statements() -> dict[str, str]:
    q: dict[str, str] = {}

    # --- reports -----------------------------------------------------------------------
    q["report_document_types"] = f"""WITH {TYPE_REPORT}
SELECT publication_type, round(share_records, 6) AS share_records, nb_records, avg_nb_authors, median_nb_authors FROM types"""
    q["report_document_types_headings"] = f"""WITH {TYPE_REPORT}
SELECT publication_type AS "Document type", round(share_records, 6) AS "Share of records (%)", nb_records AS "Count of records",
       avg_nb_authors AS "Average number of contributors by document",
       median_nb_authors AS "Median number of contributors by document"
FROM types ORDER BY share_records DESC, publication_type LIMIT 10"""
    q["report_sources"] = f"""WITH {SOURCE_REPORT}
SELECT title, {_even('share_records', 1)} AS share_records, nb_records, avg_year, avg_nb_authors, median_nb_authors FROM titles"""
    q["report_sources_top"] = f"""WITH {SOURCE_REPORT}
SELECT title, nb_records FROM titles ORDER BY nb_records DESC, title LIMIT 10"""
    q["report_years"] = f"WITH {YEAR_REPORT} SELECT * FROM yearly"
    q["trend_line"] = f"""WITH {YEAR_REPORT}
SELECT round(regr_slope(nb_records, year_published), 4) AS slope, round(regr_intercept(nb_records, year_published), 2) AS intercept
FROM yearly"""
    q["report_countries"] = f"""WITH {COUNTRY_REPORT}
SELECT c.country_code, CASE WHEN c.country_code = '??' THEN 'unknown' ELSE k.admin END AS country, nb_records, avg_nb_authors,
       median_nb_authors, avg_year, round(share_records, 6) AS share_records
FROM clean c LEFT JOIN countries k USING (country_code)"""
    # The report table as readers see it: the countries on the map, under their names there.
    countries_on_map = f"""WITH {COUNTRY_REPORT}
SELECT c.country_code, k.admin AS country, nb_records, avg_nb_authors, median_nb_authors, avg_year,
       round(share_records, 6) AS share_records
FROM clean c JOIN countries k USING (country_code)"""
    q["report_countries_all"] = f"""WITH {COUNTRY_REPORT}
SELECT c.country_code, CASE WHEN c.country_code = '??' THEN 'unknown' ELSE k.country END AS country, nb_records, avg_nb_authors,
       median_nb_authors, avg_year, round(share_records, 6) AS share_records
FROM clean c LEFT JOIN countries k USING (country_code)"""
    q["bin_values"] = f"""WITH {COUNTRY_REPORT},
mapped AS (SELECT c.country_code, nb_records FROM clean c JOIN countries k USING (country_code)),
{_bins('mapped', 'nb_records', 0)}
SELECT country_code, nb_records, bin FROM binned"""
    q["report_sources_position"] = f"""WITH {SOURCE_REPORT}
SELECT title, nb_records, row_number() OVER (ORDER BY nb_records DESC, title) AS position FROM titles"""
    q["report_countries_position"] = f"""SELECT country, nb_records, row_number() OVER (ORDER BY nb_records DESC, country, country_code) AS position
FROM ({countries_on_map})"""
    q["report_funders"] = f"""WITH {FUNDED}
SELECT org, country, nb_projects, {_even('nb_records', 0)} AS nb_records, {_even('share_projects', 1)} AS share_projects,
       {_even('share_records', 1)} AS share_records, avg_nb_authors, median_nb_authors, avg_year
FROM shares WHERE org IS NOT NULL"""
    q["report_funders_top"] = f"""WITH {FUNDED}
SELECT org, coalesce(country, 'Other') AS country, nb_projects FROM (
  SELECT * FROM shares WHERE org IS NOT NULL AND nb_projects >= 10
  ORDER BY nb_projects DESC, org NULLS LAST, country NULLS LAST LIMIT 20)"""
    q["funded_records"] = f"""WITH {FUNDED}
SELECT round(sum(nb_records) FILTER (WHERE org IS NOT NULL), 6) AS subtotal FROM shares"""
    q["report_fund_recipients"] = f"""WITH {FUNDED}
SELECT org, country, nb_projects, round(nb_records, 6) AS nb_records, round(share_projects, 6) AS share_projects,
       round(share_records, 6) AS share_records, avg_nb_authors, median_nb_authors, avg_year
FROM shares WHERE org IS NOT NULL"""
    q["report_fund_recipients_top"] = f"""WITH {FUNDED}
SELECT org, country, nb_projects FROM shares WHERE org IS NOT NULL AND nb_projects >= 10
ORDER BY nb_projects DESC, org NULLS LAST, country NULLS LAST LIMIT 20"""
    q["report_domains_disciplines"] = f"""WITH {FLOWS}
SELECT display_name_0, display_name_1, {_even('nb_1', 0)} AS nb_1, {_even('nb_0', 0)} AS nb_0,
       {_even('percentile_1 * 100', 1)} AS percentile_1, {_even('percentile_0 * 100', 1)} AS percentile_0
FROM ranked"""
    q["domain_discipline_ranks"] = f"""WITH {FLOWS}
SELECT parent_0, parent_1, round(nb_1, 6) AS nb_1, round(nb_0, 6) AS nb_0, round(percentile_0, 6) AS percentile_0,
       round(percentile_1, 6) AS percentile_1
FROM ranked"""
    q["flow_domain_discipline"] = f"""WITH {FLOWS}
SELECT display_name_0, display_name_1, round(sum(nb_1), 6) AS weight FROM leaves GROUP BY 1, 2"""
    q["flow_domain_discipline_shown"] = f"""WITH {FLOWS}
SELECT display_name_0, display_name_1, round(sum(nb_1), 6) AS weight FROM ranked
WHERE percentile_1 > 0.95 AND percentile_0 > 0.1 GROUP BY 1, 2"""
    q["domain_match_classes"] = f"""WITH {FLOWS}
SELECT t AS distance_type, round(n / d, 6) AS nb_orgs
FROM totals, (VALUES ('Exact', 5.0::DOUBLE), ('Close', 2.5::DOUBLE), ('Related', 5.0::DOUBLE / 3)) v(t, d)"""
    q["report_heroes"] = f"""SELECT 'document_types' AS report, (WITH {TYPE_REPORT} SELECT format('{{:,}}', max(nb_records)) FROM types) AS hero
UNION ALL SELECT 'sources', (WITH {SOURCE_REPORT} SELECT format('{{:,}}', count(DISTINCT title)) FROM titles)
UNION ALL SELECT 'years', (WITH {YEAR_REPORT} SELECT format('{{:,}}', CAST(sum(nb_records) AS BIGINT)) FROM yearly)
UNION ALL SELECT 'countries', (WITH {COUNTRY_REPORT} SELECT format('{{:,}}', CAST(sum(nb_records) AS BIGINT)) FROM clean)
UNION ALL SELECT 'funders', (WITH {FUNDED} SELECT format('{{:,}}', count(DISTINCT (funding_id, org))) FROM kept)
UNION ALL SELECT 'domains_disciplines', (WITH {FLOWS} SELECT format('{{:,}}', count(DISTINCT parent_1)) FROM ranked
  WHERE percentile_1 > 0.95 AND percentile_0 > 0.1)"""
    q["report_collaborations"] = f"""WITH {MAP}
SELECT e."from", e."to", a.name AS name_1, b.name AS name_2, {_even('e.weight', 1)} AS weight,
       a.nb_records AS nb_records_1, b.nb_records AS nb_records_2
FROM map_edges e JOIN map_nodes a ON a.org_id = e."from" JOIN map_nodes b ON b.org_id = e."to" """
    q["report_collaboration_map"] = f"""WITH {MAP}, {_bins('map_countries', 'nb_org', 1)}
SELECT country_code, nb_org, bin,
       '<strong>' || admin || '</strong><br/>' || format('{{:,}}', nb_org) || ' organisations' AS label
FROM binned"""
    card = (
        "'<strong>' || name || '</strong><br/>' || format('{:,}', nb_records) || ' records<br/>' || r || ' researchers<br/>' || i ||"
        " ' inventors<br/>' || p || ' projects<br/><hr/>Location: ' || l || '<br/>Topic: ' || t || '<br/>R&D strength: ' || s"
    )
    up = "CAST(ceil(nb_records / {}.0::DOUBLE) AS BIGINT)"
    q["collaboration_map_markers"] = f"""WITH {MAP},
card AS (SELECT *, {up.format(5)} AS r, {up.format(20)} AS i, {up.format(10)} AS p, {up.format(30)} AS l, {up.format(40)} AS t,
  {up.format(50)} AS s FROM map_nodes)
SELECT org_id, r AS researchers, i AS inventors, p AS projects, {card} AS label FROM card"""
    q["collaboration_map_popups"] = f"""SELECT org_id, label || '<br/>Review Profile' AS popup FROM ({q["collaboration_map_markers"]})"""
    q["report_heroes_more"] = f"""SELECT 'fund_recipients' AS report, (WITH {FUNDED} SELECT format('{{:,}}', count(DISTINCT (funding_id, org))) FROM kept) AS hero
UNION ALL SELECT 'collaborations', (WITH {MAP} SELECT format('{{:,}}', count(*)) FROM map_edges)
UNION ALL SELECT 'collaboration_map', (WITH {MAP} SELECT format('{{:,}}', count(*)) FROM map_edges)
UNION ALL SELECT 'domains_shown', (WITH {FLOWS} SELECT format('{{:,}}', CAST(ceil(coalesce(sum(nb_1), 0)) AS BIGINT)) FROM ranked
  WHERE percentile_1 > 0.95 AND percentile_0 > 0.1)
UNION ALL SELECT 'domains_total', (WITH {FLOWS} SELECT format('{{:,}}', n) FROM totals)"""
    contributors = '"Average number of contributors by document"', '"Median number of contributors by document"'
    q["report_sources_headings"] = f"""SELECT title AS "Journal", share_records AS "Share of records (%)", nb_records AS "Count of records",
       avg_year AS "Average year of publication", avg_nb_authors AS {contributors[0]}, median_nb_authors AS {contributors[1]}
FROM ({q["report_sources"]})"""
    q["report_years_headings"] = f"""SELECT year_published AS "Year of publication", nb_records AS "Count of records", avg_nb_authors AS {contributors[0]},
       median_nb_authors AS {contributors[1]} FROM ({q["report_years"]})"""
    q["report_countries_headings"] = f"""SELECT country AS "Country", nb_records AS "Count of records" FROM ({countries_on_map})"""
    q["report_funders_headings"] = f"""SELECT org AS "Funding organisation/institute", nb_projects AS "Count of projects", nb_records AS "Count of records",
       share_projects AS "Share of projects (%)", share_records AS "Share of records (%)", avg_nb_authors AS "Average number of contributors",
       median_nb_authors AS {contributors[1]}, avg_year AS "Average year of publication" FROM ({q["report_funders"]})"""
    q["report_domains_disciplines_headings"] = f"""SELECT display_name_0 AS "Domain", display_name_1 AS "Discipline",
       nb_1 AS "Count of records by discipline", nb_0 AS "Count of records by domain", percentile_1 AS "Percentile of discipline",
       percentile_0 AS "Percentile of domain" FROM ({q["report_domains_disciplines"]})"""
    q["report_collaborations_headings"] = f"""SELECT name_1 AS "Organisation 1", name_2 AS "Organisation 2", weight AS "Number of collaborations",
       nb_records_1 AS "Total count of records by organisation 1", nb_records_2 AS "Total count of records by organisation 2"
FROM ({q["report_collaborations"]})"""
    q["report_collaboration_map_simple"] = f"""WITH {MAP}
SELECT org_id, '<strong>' || name || '</strong><br/>' || format('{{:,}}', nb_records) || ' records' AS label FROM map_nodes"""
    q["map_distance_classes"] = f"""WITH {MAP}
SELECT t AS distance_type, round(m / d, 6) AS nb_orgs
FROM (SELECT max(nb_org)::DOUBLE AS m FROM map_countries),
     (VALUES ('local', 5.0::DOUBLE), ('national', 2.5::DOUBLE), ('international', 5.0::DOUBLE / 3)) v(t, d)"""
    q["graph_vertices"] = f"""WITH {edges()}, {NET_NODES} SELECT org_id AS id, name AS label, country_code AS "group" FROM net_nodes"""
    q["graph_edges"] = f"""WITH {edges()}
SELECT "from", "to", round(weight, 6) AS width, round((SELECT min(weight) FROM net), 6) AS min_width,
       round((SELECT max(weight) FROM net), 6) AS max_width
FROM net"""

    # --- network -----------------------------------------------------------------------
    out = 'SELECT "from", "to", is_ext, round(weight, 6) AS weight FROM net'
    q["collaboration_edges"] = f"WITH {edges()} {out}"
    q["collaboration_bounded"] = f"WITH {edges(most=3)} {out}"
    q["collaboration_left_out"] = f"""WITH {TEAMS}
SELECT count_if(nb_authors > 3)::BIGINT AS nb_left_out, count(*) AS nb_records FROM teams"""
    q["collaboration_nodes"] = f"""WITH {edges()}, {NET_NODES}
SELECT org_id, round(nb_contributions, 6) AS nb_contributions, nb_records, name, country_code FROM net_nodes"""
    q["collaboration_by_country"] = f"""WITH {ORGS},
placed AS (SELECT l.*, o.country_code FROM lineitem l JOIN orgs o ON o.org_id = l.l_suppkey),
{edges('country_code', 'placed')} {out}"""
    q["collaboration_sample"] = f"""WITH chosen AS (
  SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) ORDER BY md5(l_orderkey || ':42'), l_orderkey LIMIT 1000),
picked AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM chosen)),
{edges('l_suppkey', 'picked')} {out}"""
    q["collaboration_intervals"] = " UNION ALL ".join(
        f"""SELECT {a}::BIGINT AS first_year, {b}::BIGINT AS last_year, * FROM ({interval(a, b)}
SELECT "from", "to", is_ext, round(weight, 6) AS weight FROM net
WHERE "from" IN (SELECT org_id FROM largest) AND "to" IN (SELECT org_id FROM largest))""" for a, b in SPANS)
    q["collaboration_interval_nodes"] = " UNION ALL ".join(
        f"""SELECT {a}::BIGINT AS first_year, {b}::BIGINT AS last_year, * FROM ({interval(a, b)}, {ORGS}
SELECT position, org_id, round(nb_contributions, 6) AS nb_contributions, nb_records, name, country_code
FROM largest JOIN orgs USING (org_id))""" for a, b in SPANS)
    q["collaboration_lines"] = f"""WITH {edges()},
listed AS (
  SELECT s_suppkey AS org_id, s_nationkey AS g FROM supplier WHERE s_acctbal >= 0
  UNION ALL SELECT s_suppkey, (s_nationkey + 7) % 25 FROM supplier WHERE s_acctbal >= 5000),
placed AS (SELECT org_id, min(g) AS g FROM listed WHERE g > 0 GROUP BY 1)
SELECT "from", "to", round(weight, 6) AS weight, a.g * 1.5::DOUBLE AS lat_1, a.g * -2.0::DOUBLE AS lng_1,
       b.g * 1.5::DOUBLE AS lat_2, b.g * -2.0::DOUBLE AS lng_2
FROM net JOIN placed a ON a.org_id = "from" JOIN placed b ON b.org_id = "to" WHERE is_ext"""
    q["top_pairs_unweighted"] = """WITH team AS (
  SELECT l_orderkey AS r FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) <= 20),
present AS (SELECT DISTINCT l_orderkey AS r, l_suppkey AS o FROM lineitem WHERE l_orderkey IN (SELECT r FROM team))
SELECT a.o AS "from", b.o AS "to", count(*) AS nb_records FROM present a JOIN present b ON a.r = b.r AND a.o < b.o
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 30"""

    # --- taxonomy ----------------------------------------------------------------------
    q["resolve_hierarchy"] = f"""WITH RECURSIVE {NODES},
supply AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
all_edges AS (
  SELECT 'N' || n_nationkey AS child, 'R' || n_regionkey AS parent FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier
  UNION ALL SELECT 'P' || l_partkey, 'S' || l_suppkey FROM supply),
edges AS (SELECT * FROM all_edges WHERE parent IN (SELECT id FROM nodes)),
walk AS (
  SELECT id, level, 0 AS step, id AS here, CASE WHEN level = 0 THEN 'N/A' WHEN level = 1 THEN id END AS one FROM nodes
  UNION
  SELECT w.id, w.level, w.step + 1, coalesce(e.parent, '0'),
         CASE WHEN w.step + 1 = w.level - 1 THEN coalesce(e.parent, '0') ELSE w.one END
  FROM walk w LEFT JOIN edges e ON e.child = w.here WHERE w.step < w.level),
done AS (SELECT DISTINCT id, one AS parent_1, here AS parent_0 FROM walk WHERE step = level),
counts AS (SELECT id, count(DISTINCT parent_1) AS nb_parent_1, count(DISTINCT parent_0) AS nb_parent_0 FROM done GROUP BY 1)
SELECT n.id AS category_id, n.level::BIGINT AS level, n.label AS display_name, n.raw AS raw_display_name, d.parent_1, d.parent_0,
       a.label AS display_name_1, b.label AS display_name_0, c.nb_parent_1, c.nb_parent_0
FROM named n JOIN done d ON d.id = n.id JOIN counts c ON c.id = n.id
LEFT JOIN named a ON a.id = d.parent_1 LEFT JOIN named b ON b.id = d.parent_0"""
    q["discipline_labels"] = f"""WITH h AS ({q["resolve_hierarchy"]}),
below AS (SELECT * FROM h WHERE level > 0 AND parent_1 <> '0' AND display_name_1 IS NOT NULL),
sizes AS (SELECT parent_1, display_name_1, count(DISTINCT category_id) AS nb_id FROM below GROUP BY 1, 2)
SELECT DISTINCT parent_1, display_name_1, raw_display_name, nb_id FROM below JOIN sizes USING (parent_1, display_name_1)"""
    q["resolve_hierarchy_any_level"] = f"""WITH {NODES},
up AS (SELECT s_suppkey, s_nationkey, n_regionkey FROM supplier JOIN nation ON n_nationkey = s_nationkey),
done AS (
  SELECT id, 'N/A' AS parent_1, id AS parent_0 FROM nodes WHERE level = 0
  UNION ALL SELECT 'N' || n_nationkey, 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, 'R' || n_regionkey FROM up WHERE s_suppkey NOT IN (3, 5, 8, 13)
  UNION ALL SELECT id, 'N/A', 'N/A' FROM nodes WHERE level = 3)
SELECT n.id AS category_id, CASE WHEN n.level = 3 THEN 6 ELSE n.level END::BIGINT AS level, n.label AS display_name,
       n.raw AS raw_display_name, d.parent_1, d.parent_0, a.label AS display_name_1, b.label AS display_name_0,
       1::BIGINT AS nb_parent_1, 1::BIGINT AS nb_parent_0
FROM named n JOIN done d ON d.id = n.id LEFT JOIN named a ON a.id = d.parent_1 LEFT JOIN named b ON b.id = d.parent_0"""
    q["build_taxonomy_nodes"] = f"WITH {TOPICS} SELECT * FROM topic_nodes"
    q["taxonomy_parent_edges"] = f"""WITH {TOPICS}
SELECT child AS category_id, parent, count(*) OVER (PARTITION BY parent) AS nb_children FROM edges"""
    q["taxonomy_sibling_edges"] = """SELECT 'C' || c_custkey AS category_id, 'C' || (c_custkey + 1) AS sibling, 2::BIGINT AS nb_siblings
FROM customer"""
    q["resolve_topic_hierarchy"] = f"""WITH {TOPICS}, {RESOLVED_TOPICS},
counts AS (
  SELECT category_id, count(DISTINCT parent_2) AS nb_parent_2, count(DISTINCT parent_1) AS nb_parent_1,
         count(DISTINCT parent_0) AS nb_parent_0 FROM resolved GROUP BY 1)
SELECT r.*, n2.display_name AS display_name_2, n1.display_name AS display_name_1, n0.display_name AS display_name_0,
       nb_parent_2, nb_parent_1, nb_parent_0
FROM resolved r JOIN counts USING (category_id) LEFT JOIN names n2 ON n2.category_id = parent_2
LEFT JOIN names n1 ON n1.category_id = parent_1 LEFT JOIN names n0 ON n0.category_id = parent_0"""
    q["build_concept_edges"] = """SELECT 'S' || s_suppkey AS category_id, 'N' || s_nationkey AS other, 'parent' AS kind, 1::BIGINT AS nb FROM supplier
UNION ALL SELECT 'S' || s_suppkey, 'S' || (s_suppkey + 1), 'sibling', 1 FROM supplier"""
    q["link_categories"] = f"""WITH {LINKED}
SELECT lens_id, raw_display_name, category_id, parent_1, parent_0, is_not_linked FROM linked"""
    q["link_topics"] = f"""WITH {SHARED_TOPICS}, {RESOLVED_TOPICS}, {PUBS},
cats AS (
  SELECT lens_id, n_name AS value FROM pubs WHERE st = 'F' UNION ALL SELECT lens_id, c_mktsegment FROM pubs WHERE st = 'F'
  UNION ALL SELECT lens_id, NULL FROM pubs WHERE st = 'O')
SELECT lens_id, value AS display_name, category_id, level, parent_2, parent_1, parent_0,
       bool_and(category_id IS NULL) OVER (PARTITION BY lens_id) AS is_not_linked
FROM cats LEFT JOIN resolved ON display_name = value"""
    q["join_taxonomy_crosswalk"] = """SELECT 'S' || s_suppkey AS id, 'C' || c_custkey AS id_m, 'wikipedia' AS matched_by
FROM supplier JOIN customer ON replace(s_name, 'Supplier#', '') = replace(c_name, 'Customer#', '') WHERE s_acctbal >= 0
UNION ALL SELECT 'S' || s_suppkey, 'C' || c_custkey, 'wikidata' FROM supplier JOIN customer ON s_suppkey = c_custkey WHERE c_acctbal >= 0"""

    # --- citation baselines --------------------------------------------------------------
    q["unify_document_type"] = f"WITH {TYPED} SELECT lens_id, publication_type, pubtype_id FROM typed"
    q["citation_baseline"] = f"""WITH {CELLS}
SELECT parent_1, pubtype_id, year, count(*) AS nb_records, round(avg(citations), 6) AS avg_citations, min(citations) AS min_citations,
       max(citations) AS max_citations, count(DISTINCT citations) AS nb_distinct
FROM members WHERE year BETWEEN {LO} AND {HI} GROUP BY 1, 2, 3"""
    q["citation_distribution"] = f"""WITH {CELLS}
SELECT parent_1, pubtype_id, year, citations, count(*) AS nb_records FROM members WHERE year BETWEEN {LO} AND {HI} GROUP BY 1, 2, 3, 4"""
    q["normalised_impact"] = f"""WITH {CELLS},
scored AS (
  SELECT *, avg(citations) OVER (PARTITION BY parent_1, pubtype_id, year) AS mean,
         percent_rank() OVER (PARTITION BY parent_1, pubtype_id, year ORDER BY citations) AS percentile
  FROM members WHERE year BETWEEN {LO} AND {HI})
SELECT lens_id, parent_1, pubtype_id, year, citations, round(CASE WHEN mean > 0 THEN citations / mean END, 6) AS cnci,
       round(percentile, 6) AS percentile, percentile >= 0.90::DOUBLE AS is_top10, percentile >= 0.99::DOUBLE AS is_top01
FROM scored"""
    q["category_type_grid"] = f"""WITH {CELLS},
grid AS (SELECT 'N' || n_nationkey AS parent_1, t AS pubtype_id FROM nation, (VALUES ('ja'), ('cp'), ('pp')) v(t))
SELECT g.parent_1, g.pubtype_id, count(m.lens_id) AS nb_records FROM grid g LEFT JOIN members m USING (parent_1, pubtype_id) GROUP BY 1, 2"""

    # --- publications ------------------------------------------------------------------
    q["records_id"] = f"""WITH {PUBS}
SELECT lens_id, 'doi' AS type, '10.1/' || o_orderkey AS value FROM pubs WHERE st IN ('O', 'P')
UNION ALL SELECT lens_id, 'magid', CAST(o_custkey AS VARCHAR) FROM pubs WHERE st = 'P'
UNION ALL SELECT lens_id, NULL, NULL FROM pubs WHERE st NOT IN ('O', 'P')"""
    q["roundtrip_nested_json"] = q["records_id"]
    q["source_dimension"] = f"WITH {SOURCES} SELECT source_id, title, publisher_name, type, country FROM source"
    q["source_issn"] = f"""WITH {SOURCES},
numbered AS (
  SELECT s.source_id, min(t.c_custkey) AS k FROM titled t JOIN source s USING (title, publisher_name, type, country)
  WHERE t.c_mktsegment <> 'BUILDING' GROUP BY 1)
SELECT source_id, 'print' AS type, '1-' || k AS value FROM numbered UNION ALL SELECT source_id, 'electronic', '2-' || k FROM numbered"""
    q["build_records"] = f"""WITH {SOURCES}
SELECT lens_id, CAST(year(o_orderdate) AS BIGINT) AS year_published, st = 'O' AS is_open_access, o_orderpriority AS publication_type,
       nb_authors, CAST(floor(o_totalprice / 1000) AS BIGINT) AS scholarly_citations_count,
       CAST(day(o_orderdate) AS BIGINT) AS references_resolved_count,
       CAST(day(o_orderdate) + month(o_orderdate) AS BIGINT) AS references_count,
       CAST(month(o_orderdate) AS BIGINT) AS patent_citations_count, source_id
FROM titled JOIN source USING (title, publisher_name, type, country)"""
    q["build_categories"] = f"""WITH {PUBS}
SELECT lens_id, n_name AS value, CAST(NULL AS VARCHAR) AS category_id, CAST(NULL AS VARCHAR) AS qualifier,
       CAST(NULL AS VARCHAR) AS qualifier_id, 'fields_of_study' AS type FROM pubs WHERE st = 'F'
UNION ALL SELECT lens_id, c_mktsegment, NULL, NULL, NULL, 'fields_of_study' FROM pubs WHERE st = 'F'
UNION ALL SELECT lens_id, NULL, NULL, NULL, NULL, 'fields_of_study' FROM pubs WHERE st = 'O'
UNION ALL SELECT lens_id, c_mktsegment, 'D' || c_nationkey, 'methods', 'Q1', 'mesh_terms' FROM pubs WHERE st = 'F'
UNION ALL SELECT lens_id, n_name, 'D0', NULL, NULL, 'mesh_terms' FROM pubs WHERE st = 'P'
UNION ALL SELECT lens_id, c_mktsegment, 'D1', 'trends', 'Q2', 'mesh_terms' FROM pubs WHERE st = 'P'"""
    q["build_funding"] = f"""WITH {PUBS}
SELECT lens_id, c_mktsegment AS org, 'G' || c_custkey AS funding_id, n_name AS country FROM pubs WHERE st = 'F'
UNION ALL SELECT lens_id, c_mktsegment, NULL, n_name FROM pubs WHERE st = 'P'
UNION ALL SELECT lens_id, n_name, 'G' || o_orderkey, NULL FROM pubs WHERE st = 'P'
UNION ALL SELECT lens_id, NULL, NULL, NULL FROM pubs WHERE st NOT IN ('F', 'P')"""
    q["explode_contributions"] = f"""WITH {AUTHORS}
SELECT contribution_id, lens_id, author_position::BIGINT AS author_position,
       CASE WHEN nb_authors > 0 AND author_position < 3 THEN 1 ELSE 0 END::BIGINT AS nb_ids,
       CASE WHEN nb_authors = 0 OR (author_position = 2 AND st = 'P') THEN NULL WHEN author_position = 2 THEN 2 ELSE 1 END::BIGINT
         AS nb_affiliations,
       CASE WHEN nb_authors > 0 THEN 'A' || author_position END AS first_name, CASE WHEN nb_authors > 0 THEN c_name END AS last_name
FROM contribution"""
    q["contributors_id"] = f"""WITH {AUTHORS}
SELECT contribution_id, 'orcid' AS type, lens_id || '-' || author_position AS value FROM contribution
WHERE nb_authors > 0 AND author_position < 3"""
    q["build_affiliation"] = f"""WITH {AFFILIATIONS}
SELECT contribution_id || '#' || place AS affiliation_id, contribution_id, org_id
FROM lines JOIN org USING (name, country_code, grid_id)"""
    q["build_organisations"] = f"""WITH {AFFILIATIONS}
SELECT org_id, name, country_code, CASE WHEN name LIKE 'Org %' THEN 2 ELSE 0 END::BIGINT AS nb_ids FROM org"""
    q["organisations_id"] = f"WITH {AFFILIATIONS} SELECT org_id, type, value FROM org_ids"
    q["registry_match"] = f"""WITH {AFFILIATIONS}, {REGISTRY},
ids AS (
  SELECT id, 'ror' AS type, 'ror:' || c_custkey AS value, c_nationkey, n_name FROM reg WHERE c_acctbal >= 0
  UNION ALL SELECT id, 'grid', 'g' || c_custkey, c_nationkey, n_name FROM reg WHERE c_acctbal >= 0
  UNION ALL SELECT id, 'grid', 'old' || c_custkey, c_nationkey, n_name FROM reg WHERE c_acctbal >= 0)
SELECT o.org_id, min(i.id) AS id, c_nationkey::BIGINT AS geonames_id, 'City ' || c_nationkey AS name, 'N' || c_nationkey AS country_code,
       n_name AS country_name, c_nationkey * 1.5::DOUBLE AS lat, c_nationkey * -2.0::DOUBLE AS lng
FROM org_ids o JOIN ids i USING (type, value) GROUP BY o.org_id, c_nationkey, n_name"""

    concepts = f"""WITH {PUBS},
cats AS (
  SELECT lens_id, n_name AS value FROM pubs WHERE st = 'F' UNION ALL SELECT lens_id, c_mktsegment FROM pubs WHERE st = 'F'
  UNION ALL SELECT lens_id, NULL FROM pubs WHERE st = 'O')
SELECT lens_id, 'N' || n_nationkey AS category_id, 'N' || n_nationkey AS parent_1, 'R' || n_regionkey AS parent_0,
       bool_and(n_nationkey IS NULL) OVER (PARTITION BY lens_id) AS is_not_linked
FROM cats LEFT JOIN nation ON n_name = value"""
    # Authors of the documents in the place of lines, organisations in that of suppliers.
    written = f"""document_lines AS (
  SELECT split_part(contribution_id, '#', 1) AS l_orderkey, contribution_id AS l_linenumber, org_id FROM ({q["build_affiliation"]})),
{edges("org_id", "document_lines")}"""
    net_edges = f'WITH {written} SELECT "from", "to", is_ext FROM net'
    net_nodes = f"""WITH {written}
SELECT org_id, count(DISTINCT l_orderkey) AS nb_records, name, country_code FROM document_lines JOIN ({q["build_organisations"]}) USING (org_id)
WHERE org_id IN (SELECT "from" FROM net UNION SELECT "to" FROM net) GROUP BY org_id, name, country_code"""
    statements_of = {
        "records_id": q["records_id"], "source": q["source_dimension"], "source_issn": q["source_issn"], "records": q["build_records"],
        "categories": q["build_categories"], "contribution": q["explode_contributions"], "contributors_id": q["contributors_id"],
        "affiliation": q["build_affiliation"], "organisations": q["build_organisations"], "organisations_id": q["organisations_id"],
        "funding": q["build_funding"], "locations": q["registry_match"], "categories_concepts": concepts,
        "categories_topics": q["link_topics"], "net_org_edges": net_edges, "net_org_nodes": net_nodes,
    }
    q["build_publication_tables"] = " UNION ALL ".join(_digest(name, sql, PUBLICATION_DIGESTS[name]) for name, sql in statements_of.items())

    # --- registry ----------------------------------------------------------------------
    q["registry_main"] = f"""WITH {REGISTRY}
SELECT id, c_name AS ror_display, 'C' || c_custkey AS acronym,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'w' || c_custkey END AS website,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'p' || c_custkey END AS wikipedia, (1900 + c_nationkey)::BIGINT AS established,
       CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 3 WHEN 'BUILDING' THEN 2 ELSE 1 END::BIGINT AS nb_types,
       CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END::BIGINT AS nb_relationships,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'company' WHEN 'BUILDING' THEN 'education' ELSE 'other' END AS main_type,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'facility' WHEN 'BUILDING' THEN 'funder' END AS second_type,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'funder' END AS third_type, '2018-11-14' AS created_date,
       '1.0' AS created_schema_version, '2024-10-15' AS last_modified_date, '2.0' AS last_modified_schema_version
FROM reg"""
    q["registry_names"] = f"""WITH {REGISTRY}
SELECT id, 'C' || c_custkey AS value, CAST(NULL AS VARCHAR) AS lang, 'acronym' AS type FROM reg
UNION ALL SELECT id, c_name, 'en', 'ror_display' FROM reg UNION ALL SELECT id, c_name, 'en', 'label' FROM reg"""
    q["registry_external_ids"] = f"""WITH {REGISTRY}
SELECT id, 'ror' AS type, 'ror:' || c_custkey AS preferred, 'ror:' || c_custkey AS value FROM reg
UNION ALL SELECT id, 'grid', 'g' || c_custkey, 'g' || c_custkey FROM reg
UNION ALL SELECT id, 'grid', 'g' || c_custkey, 'old' || c_custkey FROM reg"""
    q["registry_locations"] = f"""WITH {REGISTRY}
SELECT id, c_nationkey::BIGINT AS geonames_id, 'City ' || c_nationkey AS name, 'N' || c_nationkey AS country_code, n_name AS country_name,
       c_nationkey * 1.5::DOUBLE AS lat, c_nationkey * -2.0::DOUBLE AS lng FROM reg"""
    q["registry_domains"] = f"WITH {REGISTRY} SELECT id, 'c' || c_custkey || '.example' AS domain FROM reg WHERE c_mktsegment = 'BUILDING'"
    q["registry_relationships"] = f"""WITH {REGISTRY}
SELECT id AS "from", 'n' || c_nationkey AS "to", 'parent' AS type, n_name AS to_ror_display FROM reg WHERE c_acctbal >= 0"""
    q["roundtrip_json_dump"] = f"""WITH {REGISTRY}
SELECT id, CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status, (1900 + c_nationkey)::BIGINT AS established FROM reg"""

    # --- searches and predicates -------------------------------------------------------
    kinds = ("click", "error", "purchase", "signup", "view")
    scores = ", ".join(f"max(value) FILTER (WHERE event_type = '{k}') AS \"{k}\"" for k in kinds)
    q["merge_searches"] = f"""WITH scores AS (SELECT user_id, {scores} FROM events GROUP BY 1),
best AS (
  SELECT user_id, event_type, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS n FROM events)
SELECT s.*, b.event_type, b.event_id, b.value FROM scores s JOIN best b USING (user_id) WHERE n = 1"""
    q["merge_searches_minimum"] = q["merge_searches"] + " AND value >= 150.0"
    q["dedupe_keep_best"] = """SELECT doc_id, n_chars, lang, sha256(text) AS digest FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC NULLS LAST, doc_id) AS n FROM documents) WHERE n = 1"""
    q["bool_predicate"] = f"""WITH {PUBS}
SELECT lens_id, CAST(year(o_orderdate) AS BIGINT) AS year_published FROM pubs
WHERE st IN ('O', 'P') AND year(o_orderdate) BETWEEN {LO} AND {HI} AND (
  o_orderpriority = '1-URGENT'
  OR (c_nationkey = 3 AND nb_authors > 0)
  OR (st = 'P' AND floor(o_totalprice / 1000) BETWEEN 100 AND 200))"""
    q["bool_predicate_full"] = f"""WITH {PUBS}, x AS (SELECT *, floor(o_totalprice / 1000) AS citations FROM pubs)
SELECT lens_id, CAST(year(o_orderdate) AS BIGINT) AS year_published FROM x
WHERE citations > 20 AND citations < 200 AND citations BETWEEN 30 AND 190 AND o_orderpriority <> '1-URGENT'
  AND NOT (c_nationkey = 3 AND (nb_authors > 1 OR (nb_authors = 1 AND st <> 'F')))"""
    q["filter_in_list"] = """SELECT p_partkey AS part_id, p_name AS label, CASE WHEN p_size > 40 THEN 'large' ELSE p_brand END AS brand
FROM part WHERE p_type NOT IN ('PROMO', 'ECONOMY') AND contains(p_name, 'ring')"""
    q["sample_keys"] = """WITH chosen AS (
  SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) ORDER BY md5(l_orderkey || ':7'), l_orderkey LIMIT 500)
SELECT l_orderkey AS lens_id, l_linenumber AS contribution_id, l_suppkey AS org_id FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM chosen)"""

    # --- grouping, windows, keys -------------------------------------------------------
    stats = """count(*) AS nb_records, round(avg(v), 6) AS avg_value, min(v) AS min_value, max(v) AS max_value,
       count(DISTINCT v) AS nb_distinct"""
    q["date_histogram"] = f"""WITH {FACTS}, x AS (SELECT *, citations AS v FROM facts)
SELECT publication_type, strftime(date_trunc('year', date_published), '%Y-%m-%d') AS bucket, {stats} FROM x GROUP BY 1, 2"""
    q["date_histogram_days"] = f"""WITH x AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS v FROM events)
SELECT event_type, strftime(date_trunc('day', ts), '%Y-%m-%d') AS bucket, {stats} FROM x GROUP BY 1, 2"""
    q["global_agg"] = f"""WITH {FACTS}
SELECT count(DISTINCT year_published) AS nb_distinct, CAST(sum(citations) AS BIGINT) AS total, count(*) AS nb_records FROM facts"""
    q["terms_agg"] = """SELECT c_name AS city, count(*) AS nb_records FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY 1 ORDER BY 1 LIMIT 50"""
    q["nested_agg"] = f"""WITH {FACTS}, x AS (SELECT f.*, c_name AS title FROM facts f JOIN customer ON c_custkey = source_id),
outer_cells AS (
  SELECT year_published, count(*) AS nb_outer, round(avg(citations), 6) AS avg_citations, max(citations) AS max_citations FROM x GROUP BY 1),
inner_cells AS (
  SELECT year_published, title, count(*) AS nb_inner, row_number() OVER (PARTITION BY year_published ORDER BY title) AS position
  FROM x GROUP BY 1, 2)
SELECT * FROM inner_cells JOIN outer_cells USING (year_published) WHERE position <= 50"""
    q["fractional_count"] = """WITH x AS (SELECT l_suppkey, count(*) OVER (PARTITION BY l_orderkey) AS k FROM lineitem)
SELECT l_suppkey AS org_id, round(sum(1.0::DOUBLE / k), 6) AS nb_records FROM x GROUP BY 1"""
    q["distinct_counts_per_record"] = """WITH x AS (SELECT DISTINCT l_orderkey AS lens_id, l_linenumber AS contribution_id, l_suppkey AS org_id FROM lineitem),
n AS (SELECT lens_id, count(DISTINCT org_id) AS nb_orgs FROM x GROUP BY 1)
SELECT * FROM x JOIN n USING (lens_id)"""
    q["count_distinct_pair"] = f"""WITH {FUNDING}
SELECT count(*) AS nb_pairs FROM (SELECT DISTINCT funding_id, org FROM funding)"""
    q["two_level_totals"] = f"""WITH {FUNDING}, leaves AS (
  SELECT country, org, count(*) AS nb_1 FROM funding WHERE country IS NOT NULL GROUP BY 1, 2)
SELECT *, CAST(sum(nb_1) OVER (PARTITION BY country) AS BIGINT) AS nb_0 FROM leaves"""
    q["window_normalise"] = """SELECT l_orderkey, l_suppkey,
       round(sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_orderkey), 6) AS weight
FROM lineitem GROUP BY 1, 2"""
    ranked = """WITH t AS (SELECT l_partkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1),
r AS (SELECT *, percent_rank() OVER (ORDER BY total) AS p FROM t)"""
    q["percent_rank_groups"] = f"{ranked} SELECT l_partkey, total, round(p, 6) AS percentile FROM r"
    q["top_percentile"] = f"{ranked} SELECT l_partkey, total FROM r WHERE p > 0.95"
    q["surrogate_key"] = """WITH x AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
k AS (SELECT *, row_number() OVER (ORDER BY l_partkey, l_suppkey) - 1 AS pair_id FROM (SELECT DISTINCT l_partkey, l_suppkey FROM x))
SELECT x.*, k.pair_id FROM x JOIN k USING (l_partkey, l_suppkey)"""
    q["pivot_type_to_column"] = """SELECT user_id, arg_min(value, event_id) FILTER (WHERE event_type = 'click') AS first_click,
       arg_min(value, event_id) FILTER (WHERE event_type = 'purchase') AS first_purchase, CAST(NULL AS DOUBLE) AS first_absent
FROM events GROUP BY 1"""
    q["year_spine"] = f"""WITH {FACTS},
spine AS (SELECT unnest(range((SELECT min(year_published) - 1 FROM facts), (SELECT max(year_published) + 2 FROM facts))) AS year_published)
SELECT s.year_published, count(f.lens_id) AS nb_records FROM spine s LEFT JOIN facts f USING (year_published) GROUP BY 1"""

    # --- scalars and nested values -----------------------------------------------------
    q["format_labels"] = """SELECT s_suppkey, replace(s_name, 'Supplier#', 'S-') AS code,
       format('{:,}', CAST(round_even(s_acctbal, 0) AS BIGINT)) AS balance, CAST(ceil(s_acctbal / 10) AS BIGINT) AS tens,
       round_even(s_suppkey / 2.0::DOUBLE, 0)::DOUBLE AS half_even, round(s_suppkey / 2.0::DOUBLE, 0)::DOUBLE AS half_up,
       '<strong>' || s_name || '</strong><br/>' || format('{:,}', s_suppkey) || ' records' AS label,
       s_nationkey * (s_nationkey - 1) / 2.0::DOUBLE AS pairs,
       CASE WHEN s_nationkey = 1 THEN 'Unknown' ELSE CAST(s_nationkey AS VARCHAR) END AS nation,
       CAST(ceil(s_acctbal / 5.0::DOUBLE) AS BIGINT) AS fifth, CAST(ceil(s_acctbal / 20.0::DOUBLE) AS BIGINT) AS twentieth
FROM supplier"""
    q["array_filter_map"] = """WITH x AS (
  SELECT vec_id, label % 3 AS level, unnest(embedding)::DOUBLE AS e, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
hit AS (SELECT * FROM x WHERE CAST(floor(e * 10) AS INT) = level - 1),
lists AS (SELECT vec_id, list(CAST(i AS VARCHAR) ORDER BY i) AS ids FROM hit GROUP BY 1)
SELECT v.vec_id, coalesce(len(ids), 0)::BIGINT AS nb, ids[2] AS second, coalesce(array_to_string(ids, ','), '') AS ids
FROM embeddings v LEFT JOIN lists USING (vec_id)"""
    q["flatten_json_props"] = """SELECT event_id, 'k' AS bucket, CAST(json_extract(props, '$.k') AS BIGINT) AS nb FROM events
WHERE json_extract(props, '$.k') IS NOT NULL"""
    q["static_code_table"] = """WITH t AS (
  SELECT 1::BIGINT AS level, (n_nationkey + 1)::BIGINT AS id, n_name AS topic_label FROM nation
  UNION ALL SELECT * FROM (VALUES (1, 0, 'Other'), (2, 0, 'Other'), (3, 0, 'Other'))),
u AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_nationkey + 1 ELSE 0 END AS id, count(*) AS n FROM customer GROUP BY 1)
SELECT t.*, CASE WHEN t.level = 1 THEN coalesce(n, 0) ELSE 0 END AS nb_records FROM t LEFT JOIN u USING (id)"""
    q["document_codes"] = f"""WITH {FACTS},
coded AS (
  SELECT CASE WHEN is_retracted THEN 'RP' WHEN publication_type = '1-URGENT' THEN 'AA' WHEN publication_type = '2-HIGH' THEN 'RR' ELSE 'OO' END AS c
  FROM facts)
SELECT k AS doctype_code, v AS doctype, (SELECT count(*) FROM coded WHERE c = k) AS nb_records
FROM (VALUES ('AA', 'Article'), ('PP', 'Proceedings paper'), ('RR', 'Review'), ('RP', 'Retracted paper'), ('PX', 'Preprint'),
  ('DD', 'Data'), ('OO', 'Other')) t(k, v)"""
    q["config_document_types"] = """SELECT lower(substr(o_orderpriority, 3, 2)) AS pubtype_id, o_orderpriority AS publication_type, count(*) AS nb_records
FROM orders GROUP BY 1, 2"""
    q["flatten_config"] = """SELECT c_mktsegment AS source, 'main' AS category, 'topic' AS type, 'topic_' || c_custkey AS id, c_name AS name,
       '{"term":{"org":' || c_custkey || '}}' AS value FROM customer
UNION ALL SELECT c_mktsegment, 'unification', 'thesaurus', 'publication_type', 'types',
       '{"ja":{"label":"J","source_types":["a","b"]}}' FROM customer"""

    # --- files -------------------------------------------------------------------------
    q["roundtrip_manifest"] = "SELECT event_id, user_id, event_type, value, props FROM events"
    q["roundtrip_gzip_json"] = "SELECT event_id, user_id, event_type, value, props FROM events"
    q["roundtrip_json_array"] = f"""WITH {REGISTRY}
SELECT id, CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status, (1900 + c_nationkey)::BIGINT AS established,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'company' WHEN 'BUILDING' THEN 'education' ELSE 'other' END AS type FROM reg"""
    q["scan_paged_first_score"] = """WITH x AS (SELECT *, event_id // 40 AS page FROM events),
first AS (SELECT event_type, min(page) AS first_page FROM x GROUP BY 1),
stamp AS (SELECT event_type, first_page, max(value) AS stamp FROM x JOIN first USING (event_type) WHERE page = first_page GROUP BY 1, 2)
SELECT event_id, user_id, CASE WHEN page > first_page THEN stamp WHEN user_id % 3 <> 0 THEN value END AS score
FROM x JOIN stamp USING (event_type)"""
    q["scan_paged_append"] = """SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN 1000.0::DOUBLE ELSE value END AS score FROM events"""
    q["roundtrip_table"] = f"WITH {FACTS} SELECT lens_id, citations, year_published FROM facts WHERE year_published >= 1998"
    q["roundtrip_tsv"] = f"""WITH {NODES} SELECT id AS category_id, label AS display_name, count(*) AS nb FROM named WHERE level = 2 GROUP BY 1, 2"""
    q["geo_features"] = """SELECT 'N' || n_nationkey AS country_code, n_name AS admin,
       '{"type":"Point","coordinates":[' || n_nationkey || ']}' AS geometry, count(*) AS nb
FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name"""
    return q
