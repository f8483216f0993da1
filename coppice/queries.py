"""Queries over the analytic tables, one or more for each operator family, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import crosscheck as Y
from .checks import validate as V
from .checks import verify as W
from .functions import notation as N
from .functions import text as X
from .linked import isomorphism as G
from .linked import nodes as L
from .linked import triples as T
from .operators import extraction as E
from .operators import intervals as I
from .operators import lookup as J
from .operators import ordered as O
from .schemas import CHANGE_TAGS, INTERVALS, LEGEND_TAGS
from .sinks import writers as K
from .sources import rdf
from .storage import parts_for, shared_dir
from .streaming.sessions import run_once
from .streaming.sessions import stream_sessions as sessions_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a query and its SQL."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        ORACLE_SQL[f.__name__] = sql
        return run

    return add


def _big(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'an' ELSE 'n' END AS charset,
    CAST(CASE WHEN p_size % 2 = 0 THEN 1 ELSE p_size END AS INTEGER) AS min_length, CAST(p_size AS INTEGER) AS max_length, p_size % 2 = 1 AS fixed FROM part""")
def notation_parse(t):
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" an.."), F.col("p_size"))).otherwise(F.concat(F.lit("n"), F.col("p_size")))
    p = t("part").select("p_partkey", N.notation(raw).alias("r"))
    # A fixed length is one written without dots; 1 and 1 are equal in both forms.
    return p.select("p_partkey", "r.charset", "r.min_length", "r.max_length", (N.fixed_length(F.col("r")) & (F.col("r.charset") == "n")).alias("fixed"))


def _bridge_text(t) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    text = F.concat(F.lit("lead UNLK: an..17 L"), F.col("l_linenumber"), F.lit(", p "), q - 1, F.lit(" - "), q + 9, F.lit(" MAR: x "), F.col("l_suppkey"))
    return t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", q.alias("q"), text.alias("text"))


@query("""SELECT l_orderkey, l_partkey, 0 AS pos, 'UNLK' AS scheme, 'an..17 L' || l_linenumber || ', p ' || (CAST(l_quantity AS INTEGER) - 1) || ' - ' || (CAST(l_quantity AS INTEGER) + 9) AS detail FROM lineitem
    UNION ALL SELECT l_orderkey, l_partkey, 1, 'MAR', 'x ' || l_suppkey FROM lineitem""")
def bridge_split(t):
    return _bridge_text(t).select("l_orderkey", "l_partkey", F.posexplode(N.bridges(F.col("text"))).alias("pos", "b")).select("l_orderkey", "l_partkey", "pos", "b.scheme", "b.detail")


@query("""SELECT l_orderkey, l_partkey, l_linenumber AS line_from, l_linenumber AS line_to, greatest(1, CAST(l_quantity AS INTEGER) - 1) AS pos_from, CAST(l_quantity AS INTEGER) + 9 AS pos_to, 'an..17' AS format FROM lineitem""")
def zone_fold(t):
    return _bridge_text(t).select("l_orderkey", "l_partkey", F.explode(N.first_zones(F.col("text"))).alias("z")).select("l_orderkey", "l_partkey", "z.*")


_NOTES = "SELECT o_orderkey AS key, [CAST(o_orderkey % 3000 AS INTEGER), CAST((o_orderkey * 7) % 3100 AS INTEGER), CAST((o_orderkey * 13) % 2500 AS INTEGER)] AS refs FROM orders"
_REFS = f"WITH n AS ({_NOTES}), u AS (SELECT key, unnest(refs) AS ref, unnest([0, 1, 2]) AS pos FROM n), c AS (SELECT * FROM u WHERE ref >= 1000 AND ref <> key AND NOT ref BETWEEN 1970 AND 2099)"


def _notes(t) -> DataFrame:
    k = F.col("o_orderkey")
    number = lambda c: F.lpad(c.cast("string"), 4, "x")  # noqa: E731  numbers under 1000 are no four-digit words
    return t("orders").select(k.alias("key"), F.concat_ws(" - ", F.lit("use"), number(k % 3000), number(k * 7 % 3100), number(k * 13 % 2500)).alias("notes"))


@query(f"{_REFS} SELECT key, arg_min(ref, pos) AS replacement FROM c JOIN part ON p_partkey = ref GROUP BY key")
def first_valid_ref(t):
    return J.first_valid_reference(_notes(t), "key", "notes", t("part"), "p_partkey")


@query(f"{_REFS} SELECT DISTINCT key, ref FROM c WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = ref)")
def dangling_refs(t):
    return J.dangling_references(_notes(t), "key", "notes", t("part"), "p_partkey")


@query("""SELECT o_orderkey, c_custkey, c_nationkey IS NOT NULL AND (o_custkey % 25) IS NOT DISTINCT FROM c_nationkey AS aligned FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'""")
def tag_join_aligned(t):
    left = t("orders").where("o_orderstatus = 'O'").withColumn("want", F.col("o_custkey") % 25)
    return J.aligned(left, t("customer"), F.col("o_custkey") == F.col("c_custkey"), [("want", "c_nationkey")], "c_nationkey").select("o_orderkey", "c_custkey", "aligned")


@query("""SELECT 'left' AS side, o_orderkey AS key FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL SELECT DISTINCT 'right', l_orderkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE l_orderkey = o_orderkey)""")
def anti_both_sides(t):
    o, l = t("orders").select("o_orderkey"), t("lineitem").select("l_orderkey")
    n = parts_for(l)
    left = J.only_in(o, l, "o_orderkey", "l_orderkey", n).select(F.lit("left").alias("side"), F.col("o_orderkey").alias("key"))
    right = J.only_in(l, o, "l_orderkey", "o_orderkey", n).select(F.lit("right").alias("side"), F.col("l_orderkey").alias("key")).distinct()
    return left.unionByName(right)


@query("SELECT event_id, user_id, EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id) AS known FROM events")
def known_unknown_split(t):
    return J.known_split(t("events").select("event_id", "user_id"), "user_id", t("customer"), "c_custkey")


@query("SELECT o_orderkey // 1000 AS k, count(*) AS n FROM orders GROUP BY 1")
def category_counts(t):
    return J.tally(J.by_category(t("orders"), "o_orderkey"), "k")


_CASE = " ".join(f"WHEN v >= {lo} AND v < {hi} THEN '{n}'" for n, lo, hi in INTERVALS)


@query(f"WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 16 AS v FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, CASE {_CASE} END AS routed FROM q")
def interval_route(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", J.interval_route(F.col("l_quantity") * 16, INTERVALS).alias("routed"))


@query("""SELECT count(DISTINCT c_mktsegment) AS files, count(*) AS elements, count(*) FILTER (WHERE c_acctbal > 0) AS active, count(*) FILTER (WHERE c_acctbal <= 0) AS retired,
    count(*) FILTER (WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING') AS active_without_name, count(*) FILTER (WHERE c_acctbal > 0 AND c_nationkey < 5) AS active_without_repr, (SELECT count(*) FROM supplier) AS review_entries FROM customer""")
def summary_counts(t):
    r = F.when(F.col("c_nationkey") >= 5, N.notation(F.concat(F.lit("an.."), "c_nationkey")))
    e = t("customer").select(F.col("c_mktsegment").alias("file"), F.when(F.col("c_acctbal") > 0, "active").otherwise("retired").alias("status"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("name"), r.alias("representation"))
    return V.summary(e, t("supplier"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    return V.duplicates(t("lineitem"), "l_orderkey", "l_linenumber")


@query("WITH c AS (SELECT unnest(string_split(regexp_replace(p_name, '\\s+', '', 'g'), '')) AS ch FROM part) SELECT ch, count(*) AS n FROM c WHERE ch <> '' GROUP BY ch")
def char_tally(t):
    return J.tally(J.characters(t("part"), "p_name"), "ch", weight="n")


_CH = "SELECT unnest(string_split(regexp_replace({c}, '\\s+', '', 'g'), '')) AS ch FROM {t}"


@query(f"""WITH a AS (SELECT ch, count(*) AS n FROM ({_CH.format(c='p_name', t='part')}) WHERE ch <> '' GROUP BY ch), b AS (SELECT ch, count(*) AS n FROM ({_CH.format(c='p_type', t='part')}) WHERE ch <> '' GROUP BY ch)
    SELECT coalesce(a.ch, b.ch) AS ch, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right FROM a FULL JOIN b ON a.ch = b.ch WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def multiset_diff(t):
    return J.multiset_diff(J.characters(t("part"), "p_name"), J.characters(t("part"), "p_type"), "ch", "n")


@query("""WITH a AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS key, count(*) AS n FROM orders GROUP BY 1)
    SELECT coalesce(a.key, b.key) AS key, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right FROM a FULL JOIN b ON a.key = b.key WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def uid_reconcile(t):
    return J.multiset_diff(t("lineitem").select(F.col("l_orderkey").alias("key")), t("orders").select(F.col("o_orderkey").alias("key")), "key")


@query("""WITH a AS (SELECT o_orderkey * 2 AS path, o_orderstatus AS c FROM orders), b AS (SELECT o_orderkey * 3 AS path, CASE WHEN o_orderkey % 5 = 0 THEN 'changed' ELSE o_orderstatus END AS c FROM orders)
    SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'extra' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.path = b.path WHERE a.c IS DISTINCT FROM b.c""")
def content_diff(t):
    o, k = t("orders"), F.col("o_orderkey")
    a = o.select((k * 2).alias("path"), F.col("o_orderstatus").alias("content"))
    b = o.select((k * 3).alias("path"), F.when(k % 5 == 0, "changed").otherwise(F.col("o_orderstatus")).alias("content"))
    return J.content_diff(a, b, "path", "content")


@query("SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def first_per_key(t):
    return O.first_per_key(t("events"), "user_id", ["ts", "event_id"], "event_type")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def last_per_key(t):
    return O.last_per_key(t("events"), "user_id", ["ts", "event_id"], "event_type")


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 43200000000 THEN 1 ELSE 0 END AS new FROM events)
    SELECT event_id, user_id, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g""")
def gap_sessions(t):
    e = t("events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return O.gap_sessions(e, ["user_id"], ["ts", "event_id"], F.col("us"), 43_200_000_000).select("event_id", "user_id", "session")


@query("""WITH g AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS record FROM conversations)
    SELECT conv_id, CAST(record AS BIGINT) AS record, string_agg(text, ' ' ORDER BY turn, text) AS text FROM g WHERE record > 0 GROUP BY conv_id, record""")
def record_grouping(t):
    return O.group_records(t("conversations"), ["conv_id"], ["turn"], F.col("role") == "user", "text")


@query("""WITH g AS (SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) SELECT * FROM g WHERE value < previous""")
def order_inversions(t):
    return O.inversions(t("events").select("event_id", "user_id", "value"), ["user_id"], ["event_id"], "value")


@query("""WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events)
    SELECT event_id, user_id, coalesce((SELECT min(b.us) FROM e b WHERE b.user_id = e.user_id AND b.us > e.us + 3600000000), us + 60000000) AS next FROM e""")
def next_larger(t):
    e = t("events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return J.next_larger(e.withColumn("v", F.col("us")), "user_id", F.col("v"), 3_600_000_000, 60_000_000).select("event_id", "user_id", "next")


_K = "SELECT o_orderkey AS key, 1000 + CAST(o_orderkey % 9 AS INTEGER) AS a, 1000 + CAST(o_orderkey % 7 AS INTEGER) AS b, 996 + CAST(o_orderkey % 8 AS INTEGER) AS c FROM orders"


@query(f"""WITH k AS ({_K}), u AS (SELECT key, 'equals' AS kind, a AS tag, 0 AS pos FROM k UNION ALL SELECT key, 'related', b, 1 FROM k UNION ALL SELECT key, 'related', c, 2 FROM k WHERE c >= 1000)
    SELECT key, arg_min(kind, pos) AS kind, tag FROM u GROUP BY key, tag""")
def ref_extract_dedupe(t):
    k = F.col("o_orderkey")
    d = F.format_string("[%d] see (%04d) and [%d]", 1000 + k % 9, 996 + k % 8, 1000 + k % 7)
    return t("orders").select(k.alias("key"), F.explode(N.code_references(F.lit("Name"), d)).alias("r")).select("key", "r.kind", "r.tag")


@query("SELECT string_split(p_name, ' ')[-1] AS tail, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, tail LIMIT 8")
def name_tail_topk(t):
    p = t("part").withColumn("name", F.replace("p_name", F.lit(" "), F.lit(".")))
    return W.name_tails(p).select("tail", "n").orderBy(F.desc("n"), "tail").limit(8)


@query("SELECT doc_id FROM documents WHERE text IS NOT NULL AND NOT suffix(text, '.')")
def open_endings(t):
    return W.open_endings(t("documents"), "doc_id", "text")


@query("""WITH p AS (SELECT a.p_partkey AS a, b.p_partkey AS b, a.p_name AS x, b.p_name AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)
    SELECT a, b, CAST(levenshtein(x, y) AS BIGINT) AS distance, CASE WHEN x = y THEN 1.0 ELSE 1 - levenshtein(x, y) / greatest(length(x), length(y)) END >= 0.8 AS similar FROM p""")
def edit_similarity(t):
    p = t("part")
    both = p.select(F.col("p_partkey").alias("a"), F.col("p_name").alias("x")).join(p.select((F.col("p_partkey") - 1).alias("a"), F.col("p_partkey").alias("b"), F.col("p_name").alias("y")), "a")
    return both.select("a", "b", F.levenshtein("x", "y").cast("long").alias("distance"), (X.similarity(F.col("x"), F.col("y")) >= 0.8).alias("similar"))


@query("SELECT page_id, regexp_replace(lower(url), '[^a-z0-9]', '', 'g') AS name, trim(regexp_replace(regexp_replace(lower(url), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g')) AS description, regexp_replace(lower(url), '[^a-z0-9]', '', 'g') = regexp_replace(lower(replace(url, '/', ' ')), '[^a-z0-9]', '', 'g') AS same FROM pages")
def norm_equality(t):
    u = F.col("url")
    return t("pages").select("page_id", X.normal_name(u).alias("name"), X.normal_description(u).alias("description"), (X.normal_name(u) == X.normal_name(F.replace(u, F.lit("/"), F.lit(" ")))).alias("same"))


@query("""WITH d AS (SELECT string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), l AS (SELECT unnest(ls) AS line, unnest(range(len(ls))) AS i, len(ls) AS n FROM d),
    w AS (SELECT i, n, string_split_regex(trim(line), '\\s+') AS ws FROM l), x AS (SELECT i, n, unnest(ws) AS w, unnest(range(len(ws))) AS j, len(ws) AS m FROM w),
    c AS (SELECT regexp_replace(lower(w), '[^a-z]', '', 'g') AS word, i < n - 1 AND j = m - 1 AS lo FROM x)
    SELECT word, count(*) FILTER (WHERE NOT lo) AS strict, count(*) FILTER (WHERE lo) AS loose FROM c WHERE length(word) >= 3 GROUP BY word""")
def vocab_tally(t):
    return O.vocabulary_tally(t("documents").where("text IS NOT NULL").select(F.split("text", "\n").alias("fragments")))


@query("""SELECT n_nationkey, n_name AS label, r_name AS region, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey""")
def nested_nodes(t):
    c = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).join(c, "n_nationkey", "left")
    node = n.select("n_nationkey", F.to_json(F.struct(L.iri("https://example.org/", "nations", F.col("n_nationkey")).alias("@id"), F.col("n_name").alias("label"), F.struct(F.col("r_name").alias("label")).alias("region"), F.coalesce("n", F.lit(0)).alias("customers"))).alias("json"))
    return node.select("n_nationkey", F.get_json_object("json", "$.label").alias("label"), F.get_json_object("json", "$.region.label").alias("region"), F.get_json_object("json", "$.customers").cast("long").alias("customers"))


_TRIPLES = """SELECT 'nation/' || n_nationkey AS s, 'label' AS p, n_name AS o FROM nation UNION ALL SELECT 'nation/' || n_nationkey, 'region', 'region/' || n_regionkey FROM nation
    UNION ALL SELECT 'region/' || r_regionkey, 'label', r_name FROM region WHERE r_regionkey < {k}"""


def _triples(t, k: int) -> DataFrame:
    n = T.triples(t("nation"), F.concat(F.lit("nation/"), "n_nationkey"), {"label": F.col("n_name"), "region": F.concat(F.lit("region/"), "n_regionkey")})
    return n.unionByName(T.triples(t("region").where(F.col("r_regionkey") < k), F.concat(F.lit("region/"), "r_regionkey"), {"label": F.col("r_name")}))


@query(_TRIPLES.format(k=5))
def triples(t):
    return _triples(t, 5)


@query(f"WITH x AS ({_TRIPLES.format(k=3)}) SELECT DISTINCT o AS missing FROM x WHERE p = 'region' AND o NOT IN (SELECT s FROM x)")
def graph_closure(t):
    return T.unresolved(_triples(t, 3), ["region"])


@query("SELECT DISTINCT o_orderpriority AS term FROM orders EXCEPT SELECT DISTINCT replace(o_orderpriority, '5-LOW', 'low') FROM orders")
def set_difference(t):
    p = F.col("o_orderpriority")
    return t("orders").select(p.alias("term")).distinct().subtract(t("orders").select(F.replace(p, F.lit("5-LOW"), F.lit("low")).alias("term")))


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def csv_flatten(t):
    e = t("events").withColumn("own", F.struct(F.get_json_object("props", "$.k").try_cast("long").alias("k")))
    return K.flat(e, ["event_id", "event_type", "k"], {"k": "own.k"})


@query("""SELECT o_orderkey AS key, 'status is unknown' AS rule FROM orders WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL SELECT o_orderkey, 'priority is unknown' FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    UNION ALL SELECT o_orderkey, 'key outside its range' FROM orders WHERE NOT o_orderkey BETWEEN (o_orderkey // 1000) * 1000 AND (o_orderkey // 1000) * 1000 + 699""")
def constraint_violations(t):
    base = F.floor(F.col("o_orderkey") / 1000) * 1000
    rules = {"status is unknown": ~F.col("o_orderstatus").isin("O", "F"), "priority is unknown": ~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "key outside its range": ~F.col("o_orderkey").between(base, base + 699)}
    return V.violations(t("orders"), "o_orderkey", rules)


@query("""WITH e AS (SELECT CAST(p_partkey AS INTEGER) AS key, p_size, p_partkey - (p_partkey // 1000) * 1000 AS rest FROM part)
    SELECT key, 'change_tag is unknown' AS rule FROM e WHERE p_size % 10 = 0 UNION ALL SELECT key, 'status is unknown' FROM e WHERE p_size % 7 = 0 UNION ALL SELECT key, 'provenance is missing' FROM e WHERE p_size % 9 = 0
    UNION ALL SELECT key, 'notation is missing' FROM e WHERE p_size % 5 > 0 AND p_size % 11 = 0 UNION ALL SELECT key, 'charset is unknown' FROM e WHERE p_size % 5 > 0 AND p_size % 3 = 0 UNION ALL SELECT key, 'tag outside its file''s range' FROM e WHERE rest > 699""")
def element_violations(t):
    """The rules of the directory's elements on parts, some of them with faults."""
    n, r = F.col("provenance.page"), F.col("representation")
    e = _elements(t).withColumn("file", F.format_string("%04d-%04d.yaml", (F.floor(F.col("tag") / 1000) * 1000).cast("int"), (F.floor(F.col("tag") / 1000) * 1000 + 699).cast("int")))
    shape = F.when(r.isNotNull(), F.struct(F.when(n % 11 > 0, r.raw).alias("raw"), F.when(n % 3 == 0, "b").otherwise(r.charset).alias("charset"), r.min_length.alias("min_length"), r.max_length.alias("max_length")))
    e = e.withColumns({"change_tag": F.when(n % 10 == 0, "zz").otherwise(F.col("change_tag")), "status": F.when(n % 7 == 0, "odd").otherwise(F.col("status")), "representation": shape, "provenance": F.struct(F.when(n % 9 > 0, n).alias("page"))})
    return V.violations(e, "tag", V.element_rules())


@query("SELECT p_partkey, p_name FROM part ORDER BY (p_partkey * 7919 + 42) % 104729, p_partkey LIMIT 60")
def seeded_sample(t):
    return J.seeded_sample(t("part"), (F.col("p_partkey") * 7919 + 42) % 104729, 60, "p_partkey").select("p_partkey", "p_name")


_ACTIVE = "SELECT p_partkey AS tag FROM part WHERE p_retailprice >= 1000"
_LISTS = "SELECT l_partkey AS id, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT -1, 7"


def _elements(t) -> DataFrame:
    """Parts as elements: key, name, type as description, size as notation; the cheap ones are retired."""
    raw = F.when(F.col("p_size") % 5 > 0, F.concat(F.lit("an.."), "p_size"))
    return t("part").select(
        F.col("p_partkey").cast("int").alias("tag"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), N.notation(raw).alias("representation"), F.when(F.col("p_retailprice") >= 1000, "active").otherwise("retired").alias("status"),
        F.lit("add").alias("change_tag"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("old_name"), F.when(F.col("p_size") % 3 == 0, F.col("p_type")).alias("business_term"), F.struct(F.col("p_size").alias("page")).alias("provenance"),
        F.concat(F.lit("UNLK: an..3 L "), "p_size", F.lit(", P 0-9 MAR: x")).alias("bridges"),
    )


def _lists(t) -> DataFrame:
    n = J.tally(t("lineitem"), "l_partkey").select(F.col("l_partkey").alias("id"), "n")
    return n.unionByName(n.sparkSession.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit(7).cast("long").alias("n")))


@query(f"WITH a AS ({_ACTIVE}), c AS ({_LISTS}) SELECT a.tag, c.n AS code_values FROM a JOIN c ON a.tag = c.id")
def code_coverage(t):
    return J.code_coverage(_elements(t), _lists(t)).select(F.col("tag").cast("long").alias("tag"), "code_values")


@query(f"WITH a AS ({_ACTIVE}), c AS ({_LISTS}) SELECT count(*) AS elements, CAST(sum(n) AS BIGINT) AS code_values, (SELECT count(*) FROM c WHERE id NOT IN (SELECT p_partkey FROM part)) AS skipped FROM a JOIN c ON a.tag = c.id")
def header_counts(t):
    links, lost = J.code_coverage(_elements(t), _lists(t)), J.skipped_ids(_elements(t), _lists(t))
    return links.agg(F.count("*").alias("elements"), F.sum("code_values").alias("code_values")).crossJoin(lost.agg(F.count("*").alias("skipped")))  # one row each


@query("""SELECT count(*) FILTER (WHERE active) AS joined, count(*) FILTER (WHERE active AND p_size % 5 > 0 AND k % 3 > 0) AS repr_match, count(*) FILTER (WHERE active AND p_size % 5 > 0 AND k % 3 = 0) AS repr_diff,
    count(*) FILTER (WHERE active AND k % 4 > 0) AS name_match, count(*) FILTER (WHERE active AND 1 - 5 / (length(p_type) + 5) >= 0.85 OR active AND k % 7 > 0) AS desc_match,
    count(*) FILTER (WHERE active AND 1 - 5 / (length(p_type) + 5) < 0.85 AND k % 7 = 0) AS desc_diff, CAST(0 AS BIGINT) AS only_ours, count(*) FILTER (WHERE NOT active) AS only_mirror
    FROM (SELECT *, p_retailprice >= 1000 AS active, p_partkey AS k FROM part)""")
def crosscheck_counters(t):
    k = F.col("p_partkey")
    mirror = t("part").select(
        k.cast("int").alias("tag"), F.when(k % 4 > 0, F.concat(F.upper("p_name"), F.lit(" -"))).otherwise(F.concat("p_name", F.lit("x"))).alias("name"), F.when(k % 7 > 0, F.concat(F.lower("p_type"), F.lit("  ."))).otherwise(F.concat("p_type", F.lit("abcde"))).alias("desc"),
        F.lit("an").alias("type"), (F.col("p_size") + (k % 3 == 0).cast("int")).alias("max_length"),
    )
    return Y.counters(_elements(t), mirror).select(*[F.col(c).cast("long").alias(c) for c in ("joined", "repr_match", "repr_diff", "name_match", "desc_match", "desc_diff", "only_ours", "only_mirror")])


_REVIEWS = "SELECT o_orderkey AS key, o_orderkey % 11 AS a, o_orderkey % 7 AS b, o_orderkey % 5 AS c FROM orders"
_TAGS = [*CHANGE_TAGS, "zz"]


@query(f"""WITH r AS ({_REVIEWS}), g AS (SELECT *, [{', '.join(f"'{x}'" for x in _TAGS)}][a + 1] AS tag FROM r)
    SELECT key, 'representation' AS field, 'bad ' || b AS fragment FROM g WHERE b > 3 UNION ALL SELECT key, 'name', NULL FROM g WHERE c = 0 AND tag <> 'x'
    UNION ALL SELECT key, 'change_tag', tag FROM g WHERE tag NOT IN ({', '.join(f"'{x}'" for x in LEGEND_TAGS)})""")
def review_rules(t):
    k = F.col("o_orderkey")
    tag = F.element_at(F.array(*map(F.lit, _TAGS)), (k % 11 + 1).cast("int"))
    raw = F.when(k % 7 > 3, F.concat(F.lit("bad "), k % 7)).when(k % 7 > 0, F.lit("an..3"))
    r = t("orders").select(k.alias("key"), tag.alias("change_tag"), X.null_if_blank(F.when(k % 5 == 0, ".").otherwise("Name")).alias("name"), raw.alias("raw")).withColumn("parsed", N.notation(F.col("raw")))
    cells = F.create_map(F.lit("representation"), F.array(F.col("raw")))
    found = r.select("key", F.explode(E.review_rules(r, "change_tag", "name", "raw", "parsed", cells)).alias("e"))
    return found.select("key", "e.field", F.get("e.raw_fragments", F.lit(0)).alias("fragment"))


@query("SELECT count(*) AS wrapped_cells FROM documents WHERE contains(text, chr(10))")
def wrapped_cells(t):
    return E.wrapped_cells(t("documents").select(F.split("text", "\n").alias("fragments")))


@query("""SELECT (SELECT count(*) FROM lineitem) AS zones, (SELECT CAST(sum(length(p_name)) AS BIGINT) FROM part) AS characters, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 9000 >= 1000) AS replacements""")
def corpus_totals(t):
    zones = W.zone_total(_bridge_text(t), "text")
    chars = W.text_length(t("part"), "p_name").withColumnRenamed("n", "characters")
    notes = t("orders").select(F.when(F.col("o_orderstatus") == "F", "retired").otherwise("active").alias("status"), F.concat(F.lit("use "), F.col("o_orderkey") % 9000).alias("notes"))
    return zones.crossJoin(chars).crossJoin(W.replacement_count(notes).withColumnRenamed("n", "replacements"))  # one row each


@query("""WITH e AS (SELECT event_id // 64 AS page, event_id AS n, CAST(floor(value) AS BIGINT) AS tag FROM events), g AS (SELECT *, lag(tag) OVER (ORDER BY n) AS previous, lag(page) OVER (ORDER BY n) AS previous_page FROM e)
    SELECT page, tag, previous, previous_page FROM g WHERE tag < previous""")
def reading_order(t):
    return W.reading_order(t("events").select(F.expr("event_id div 64").alias("page"), F.col("event_id").alias("n"), F.floor("value").alias("tag")))


@query("""WITH w AS (SELECT DISTINCT l_orderkey AS page, l_linenumber AS n, CAST(l_linenumber * 7 AS DOUBLE) AS y FROM lineitem)
    SELECT page, 1000 + n AS tag, y - 1 AS y0, coalesce((SELECT min(b.y) - 1 FROM w b WHERE b.page = w.page AND b.y > w.y + 10), y + 60) AS y1 FROM w""")
def row_bands(t):
    w = t("lineitem").select(F.col("l_orderkey").alias("page"), "l_linenumber").distinct()
    return O.row_bands(w.select("page", F.lit(110.0).alias("x"), (F.col("l_linenumber") * 7).cast("double").alias("y"), (F.col("l_linenumber") + 1000).cast("string").alias("text")), 10.0)


_SPACE = "https://example.org/ns/directory#"


@query(f"""WITH e AS (SELECT *, 'https://example.org/elements/' || p_partkey AS s FROM part WHERE p_partkey >= 1000), x AS (
    SELECT s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p, '{_SPACE}TradeDataElement' AS o, 'iri' AS kind FROM e UNION ALL SELECT s, '{_SPACE}tag', CAST(p_partkey AS VARCHAR), 'integer' FROM e
    UNION ALL SELECT s, 'https://schema.org/isPartOf', 'https://example.org/dataset/directory', 'iri' FROM e UNION ALL SELECT s, '{_SPACE}category', 'https://example.org/categories/1000-1699', 'iri' FROM e WHERE p_partkey < 2000
    UNION ALL SELECT s, '{_SPACE}category', 'https://example.org/categories/' || (p_partkey // 1000) * 1000 || '-' || (p_partkey // 1000) * 1000 + 699, 'iri' FROM e WHERE p_partkey BETWEEN 2000 AND 9999
    UNION ALL SELECT s, '{_SPACE}changeTag', 'add', 'string' FROM e UNION ALL SELECT s, '{_SPACE}status', CASE WHEN p_retailprice >= 1000 THEN 'active' ELSE 'retired' END, 'string' FROM e UNION ALL SELECT s, '{_SPACE}sourcePage', CAST(p_size AS VARCHAR), 'integer' FROM e
    UNION ALL SELECT s, 'https://schema.org/name', p_name, 'string' FROM e UNION ALL SELECT s, 'https://schema.org/description', p_type, 'string' FROM e UNION ALL SELECT s, '{_SPACE}bridges', 'UNLK: an..3 L ' || p_size || ', P 0-9 MAR: x', 'string' FROM e
    UNION ALL SELECT s, 'http://www.w3.org/2004/02/skos/core#altLabel', p_brand, 'string' FROM e WHERE p_size % 2 = 0 UNION ALL SELECT s, 'http://www.w3.org/2004/02/skos/core#altLabel', p_type, 'string' FROM e WHERE p_size % 3 = 0 AND (p_size % 2 > 0 OR p_type <> p_brand)
    UNION ALL SELECT s, '{_SPACE}representation', NULL, 'blank' FROM e WHERE p_size % 5 > 0 UNION ALL SELECT s, '{_SPACE}bridge', NULL, 'blank' FROM e UNION ALL SELECT s, '{_SPACE}bridge', NULL, 'blank' FROM e
    UNION ALL SELECT NULL, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', '{_SPACE}Bridge', 'iri' FROM e, range(2) UNION ALL SELECT NULL, '{_SPACE}scheme', 'UNLK', 'string' FROM e UNION ALL SELECT NULL, '{_SPACE}scheme', 'MAR', 'string' FROM e
    UNION ALL SELECT NULL, '{_SPACE}detail', 'an..3 L ' || p_size || ', P 0-9', 'string' FROM e UNION ALL SELECT NULL, '{_SPACE}detail', 'x', 'string' FROM e UNION ALL SELECT NULL, '{_SPACE}zone', NULL, 'blank' FROM e
    UNION ALL SELECT NULL, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', '{_SPACE}UnlkZone', 'iri' FROM e UNION ALL SELECT NULL, '{_SPACE}lineFrom', CAST(p_size AS VARCHAR), 'integer' FROM e UNION ALL SELECT NULL, '{_SPACE}lineTo', CAST(p_size AS VARCHAR), 'integer' FROM e
    UNION ALL SELECT NULL, '{_SPACE}posFrom', '1', 'integer' FROM e UNION ALL SELECT NULL, '{_SPACE}posTo', '9', 'integer' FROM e UNION ALL SELECT NULL, '{_SPACE}fieldFormat', 'an..3', 'string' FROM e
    UNION ALL SELECT NULL, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', '{_SPACE}Representation', 'iri' FROM e WHERE p_size % 5 > 0 UNION ALL SELECT NULL, '{_SPACE}printedForm', 'an..' || p_size, 'string' FROM e WHERE p_size % 5 > 0 UNION ALL SELECT NULL, '{_SPACE}charset', 'an', 'string' FROM e WHERE p_size % 5 > 0
    UNION ALL SELECT NULL, '{_SPACE}minLength', '1', 'integer' FROM e WHERE p_size % 5 > 0 UNION ALL SELECT NULL, '{_SPACE}maxLength', CAST(p_size AS VARCHAR), 'integer' FROM e WHERE p_size % 5 > 0) SELECT s, p, o, kind, count(*) AS n FROM x GROUP BY ALL""")
def element_graph(t):
    """Statements of element nodes; the names of nested nodes, which only have to differ, are left out."""
    none = t("part").sparkSession.createDataFrame([], "key int, replacement int")
    s = T.node_triples(L.element_nodes(_elements(t).where("tag >= 1000"), none, "https://example.org"), T.names(_SPACE))
    named = lambda c: F.when(~F.col(c).startswith("_:"), F.col(c)).alias(c)
    return s.select(named("s"), "p", F.when(F.col("kind") != "blank", F.col("o")).alias("o"), "kind").groupBy("s", "p", "o", "kind").agg(F.count("*").alias("n"))


@query(f"""SELECT '<https://example.org/suppliers/' || s_suppkey || '> <{_SPACE}tag> "' || s_suppkey || '"^^<http://www.w3.org/2001/XMLSchema#integer> .' AS value FROM supplier UNION ALL SELECT '<https://example.org/suppliers/' || s_suppkey || '> <https://schema.org/name> "' || s_name || '" .' FROM supplier""")
def n_triples(t):
    n = t("supplier").select(F.struct(L.iri("https://example.org", "suppliers", F.col("s_suppkey")).alias("@id"), F.col("s_suppkey").alias("tag"), F.col("s_name").alias("name")).alias("node"))
    return K.n_triples(T.node_triples(n, T.names(_SPACE)))


@query(f"""SELECT 'https://example.org/suppliers/' || s_suppkey AS subject, '<https://example.org/suppliers/' || s_suppkey || '> a utd:Bridge ;' || chr(10) || '  schema:name "' || s_name || '" ;' || chr(10) || '  utd:tag ' || s_suppkey || ' .' || chr(10) AS text FROM supplier""")
def turtle_blocks(t):
    n = t("supplier").select(F.struct(L.iri("https://example.org", "suppliers", F.col("s_suppkey")).alias("@id"), F.lit("Bridge").alias("@type"), F.col("s_suppkey").alias("tag"), F.col("s_name").alias("name")).alias("node"))
    return K.turtle(T.node_triples(n, T.names(_SPACE)), _SPACE)


@query(f"""SELECT '{_SPACE}' || x AS iri, 'unused' AS gap FROM (SELECT unnest(['changeTag', 'zone']) AS x) UNION ALL SELECT '{_SPACE}status', 'undeclared'""")
def vocabulary_gaps(t):
    n = t("supplier").select(F.struct(L.iri("https://example.org", "suppliers", F.col("s_suppkey")).alias("@id"), F.lit("active").alias("status"), F.col("s_suppkey").alias("tag"), F.col("s_name").alias("name")).alias("node"))
    return T.vocabulary_gaps(T.node_triples(n, T.names(_SPACE)), _SPACE, ["tag", "changeTag", "zone"])


@query("SELECT c_custkey, upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2) AS label, format('{} ({}) {}', c_custkey, c_nationkey, c_mktsegment) AS header, CAST(coalesce(nullif(regexp_extract(c_name, '^[0-9]+'), ''), '0') AS INTEGER) AS number FROM customer")
def labels_and_headers(t):
    return t("customer").select("c_custkey", X.capitalised(F.lower("c_mktsegment")).alias("label"), X.header(F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"), F.col("c_mktsegment")).alias("header"), X.leading_int(F.col("c_name")).alias("number"))


@query("""WITH r AS (SELECT 'name' AS field, p_partkey % 4 > 0 AS pass, false AS unreadable FROM part UNION ALL SELECT 'repr', CASE WHEN p_partkey % 7 > 0 THEN p_partkey % 3 > 0 END, p_partkey % 7 = 0 FROM part WHERE p_size % 5 > 0)
    SELECT field, count(*) FILTER (WHERE pass) AS passes, count(*) - count(*) FILTER (WHERE unreadable) AS total, count(*) FILTER (WHERE unreadable) AS unreadable, least(5, count(*) FILTER (WHERE NOT pass)) AS shown FROM r GROUP BY field""")
def agreement_report(t):
    e, k = _elements(t), F.col("tag")
    expected = e.select("tag", F.lit("name").alias("field"), F.col("name").alias("expected")).unionByName(e.select("tag", F.lit("repr").alias("field"), F.col("representation.raw").alias("expected")))
    names = e.select("tag", F.lit("name").alias("field"), F.when(k % 4 > 0, F.upper("name")).otherwise("zzz").alias("ocr"))
    reprs = e.select("tag", F.lit("repr").alias("field"), F.when(k % 7 == 0, "l1I").when(k % 3 > 0, F.concat(F.lit("| "), "representation.raw", F.lit(" ."))).otherwise("n999").alias("ocr"))
    report = Y.agreement(Y.ocr_results(expected, names.unionByName(reprs)))
    return report.select("field", "passes", "total", "unreadable", F.size("failures").cast("long").alias("shown"))


@query("""WITH r AS (SELECT o_orderkey AS key, 1000 + o_orderkey % 9 AS tag, 'equals' AS kind FROM orders UNION ALL SELECT o_orderkey, 9990 + o_orderkey % 8, 'related' FROM orders)
    SELECT tag, count(*) AS refs, count(*) FILTER (WHERE kind = 'equals') AS equals, min(key) AS first, true AS known FROM r WHERE tag IN (SELECT p_partkey FROM part) GROUP BY tag UNION ALL SELECT DISTINCT tag, 0, 0, NULL, false FROM r WHERE tag NOT IN (SELECT p_partkey FROM part)""")
def grouped_nest(t):
    k = F.col("o_orderkey")
    entries = t("orders").select(k.alias("code_list"), F.lit(1).alias("entry"), F.lit("AB").alias("code"), F.lit("Name").alias("name"), F.format_string("[%d] see (%d)", 1000 + k % 9, 9990 + k % 8).alias("description"))
    refs, e = J.references(entries), _elements(t)
    # Lists in pieces: a tag may have any number of references.
    pieces = J.nested_references(refs, e, 4096, parts_for(t("orders")))
    equals = F.size(F.filter("refs", lambda r: r.kind == "equals"))
    known = pieces.groupBy(F.col("tag").cast("long").alias("tag")).agg(F.sum(F.size("refs")).alias("refs"), F.sum(equals).alias("equals"), F.min_by(F.get("refs", F.lit(0)).code_list, "part").alias("first")).withColumn("known", F.lit(True))
    lost = J.unknown_tags(refs, e).select(F.col("tag").cast("long").alias("tag"), F.lit(0).cast("long").alias("refs"), F.lit(0).cast("long").alias("equals"), F.lit(None).cast("long").alias("first"), F.lit(False).alias("known"))
    return known.unionByName(lost)


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, event_id) > 60000000 THEN 1 ELSE 0 END AS new FROM events)
    SELECT event_id, CAST(sum(new) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g""")
def all_gap_sessions(t):
    """Sessions of all events as one group, which no task holds."""
    e = t("events").select("event_id", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return O.gap_sessions(e, [], ["ts", "event_id"], F.col("us"), 60_000_000, spread=True).select("event_id", "session")


@query("""WITH e AS (SELECT event_id, event_type, user_id % 7 = 0 AS start FROM events), g AS (SELECT *, sum(CASE WHEN start THEN 1 ELSE 0 END) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS record FROM e)
    SELECT CAST(record AS BIGINT) AS record, string_agg(event_type, ' ' ORDER BY event_id) AS event_type FROM g WHERE record > 0 GROUP BY record""")
def all_records(t):
    """Records of all events as one list."""
    e = t("events").select("event_id", "event_type", (F.col("user_id") % 7 == 0).alias("start"))
    return O.group_records(e, [], ["event_id"], F.col("start"), "event_type", spread=True)


@query("""WITH g AS (SELECT event_id, value, lag(value) OVER (ORDER BY event_id) AS previous FROM events) SELECT * FROM g WHERE value < previous""")
def all_inversions(t):
    return O.inversions(t("events").select("event_id", "value"), [], ["event_id"], "value", spread=True)


@query("""WITH b AS (SELECT c_custkey, k, c_acctbal % 50 + k * 20 AS y0, c_acctbal % 50 + k * 20 + 15 AS y1 FROM customer, (SELECT unnest([0, 1, 2, 3]) AS k))
    SELECT event_id, user_id, k FROM events JOIN b ON user_id = c_custkey AND value >= y0 AND value < y1""")
def interval_join(t):
    b = t("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("b"), F.explode(F.array(*map(F.lit, range(4)))).alias("k"))
    b = b.select("user_id", "k", (F.col("b") % 50 + F.col("k") * 20).alias("y0"), (F.col("b") % 50 + F.col("k") * 20 + 15).alias("y1"))
    e = t("events").select("event_id", "user_id", "value")
    return I.interval_join(e, b, ["user_id"], "value", "y0", "y1", 15.0, parts_for(e)).select("event_id", "user_id", "k")


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS page, l_linenumber AS n FROM lineitem), w AS (SELECT page, n, n * 7.0 AS y FROM l), b AS (SELECT page, 1000 + n AS tag, y - 1 AS y0, coalesce((SELECT min(b.y) - 1 FROM w b WHERE b.page = w.page AND b.y > w.y + 3), y + 60) AS y1 FROM w),
    x AS (SELECT w.page, tag, n, unnest(['name', 'notes']) AS "column" FROM w JOIN b ON w.page = b.page AND w.y >= b.y0 AND w.y < b.y1)
    SELECT page, tag, "column", string_agg("column" || ' ' || n, ' / ' ORDER BY n) AS text FROM x GROUP BY ALL""")
def band_cells(t):
    """Words of two columns, a line for each number, into the bands of the numbers."""
    l = t("lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line"))
    n = parts_for(l)
    l = l.repartition(n, "page").distinct()
    word = lambda x, text: F.struct(F.lit(x).alias("x"), (F.col("line") * 7).cast("double").alias("y"), F.lit(0).alias("word_no"), text.alias("text"))
    three = F.array(word(110.0, (F.col("line") + 1000).cast("string")), word(140.0, F.concat(F.lit("name "), "line")), word(660.0, F.concat(F.lit("notes "), "line")))
    words = l.select("page", "line", F.explode(three).alias("w")).select("page", "line", "w.*")
    column = F.nullif(J.interval_route(F.col("x"), INTERVALS), F.lit("uid"))
    return O.band_cells(words, O.row_bands(words), column, n).select("page", "tag", "column", F.array_join("fragments", " / ").alias("text"))


@query("""WITH e AS (SELECT p_partkey // 1000 AS category, CASE WHEN p_retailprice >= 1000 THEN 'active' ELSE 'retired' END AS status, CASE WHEN p_size % 5 > 0 THEN 'an' END AS charset, p_size FROM part)
    SELECT category, status, charset, CAST(grouping_id(category, status, charset) AS BIGINT) AS level, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS pages FROM e GROUP BY ROLLUP (category, status, charset)""")
def grouped_counts(t):
    e = _elements(t)
    keys = {"category": F.floor(F.col("tag") / 1000).cast("long"), "status": F.col("status"), "charset": F.col("representation.charset")}
    return J.grouped_counts(e, keys, {"pages": F.col("provenance.page")}).withColumn("level", F.col("level").cast("long"))


_COUNTED = ORACLE_SQL["element_graph"]


@query(_COUNTED)
def graph_round_trip(t):
    """The statements of ``element_graph`` after they were written as Turtle files and read back in splits."""
    none = t("part").sparkSession.createDataFrame([], "key int, replacement int")
    s = T.node_triples(L.element_nodes(_elements(t).where("tag >= 1000"), none, "https://example.org"), T.names(_SPACE))
    folder = shared_dir(s.sparkSession, "graph")
    # Files of some thousand elements, so that one fits a row however many there are.
    K.write_files(K.turtle_files(s, _SPACE, max(32, t("part").count() // 4096)), folder)
    read = rdf.turtle(s.sparkSession, folder, 1 << 20)
    named = lambda c: F.when(~F.col(c).startswith("_:"), F.col(c)).alias(c)
    return read.select(named("s"), "p", F.when(F.col("kind") != "blank", F.col("o")).alias("o"), "kind").groupBy("s", "p", "o", "kind").agg(F.count("*").alias("n"))


@query("""SELECT p, count(*) AS n_left, count(*) AS n_right FROM supplier, (SELECT unnest(['name', 'nation', 'tag']) AS p) WHERE s_suppkey % 10 = 0 GROUP BY p""")
def graph_differences(t):
    """Two graphs of blank nodes with other labels and some other names; a changed node's statements all differ."""
    k = F.col("s_suppkey")

    def graph(label, name):
        return T.node_triples_of(t("supplier"), F.concat(F.lit("_:"), label), {"name": (name, "string"), "nation": (F.concat(F.lit("nation/"), "s_nationkey"), "iri"), "tag": (k, "integer")})

    left = graph(F.concat(F.lit("a"), k), F.col("s_name"))
    right = graph(F.concat(F.lit("b"), k * 7), F.when(k % 10 == 0, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name")))
    return G.graph_differences(left, right).groupBy("p").agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 43200000000 THEN 1 ELSE 0 END AS new FROM events),
    s AS (SELECT user_id, epoch_us(ts) AS us, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
    SELECT user_id, min(us) AS first, max(us) AS last, count(*) AS n FROM s GROUP BY user_id, session""")
def stream_sessions(t):
    """The sessions of ``gap_sessions`` from a stream: events come in batches, out of order by two days and more, then one far later row closes all."""
    e = t("events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    spark, folder = e.sparkSession, shared_dir(e.sparkSession, "stream")
    span = e.agg(F.min(F.unix_seconds("ts")).alias("lo"), F.max(F.unix_seconds("ts")).alias("hi")).first()
    lo, width = span.lo or 0, ((span.hi or 0) - (span.lo or 0)) // 8 + 1
    # Rows go to the batch of their time, or of a time up to two days later, so that none comes later than this.
    lateness = 2 * 86_400 + width
    batch = F.least(F.lit(7), F.floor((F.unix_seconds("ts") + F.pmod(F.xxhash64("user_id", "ts"), F.lit(2 * 86_400)) - lo) / width)).cast("int")
    for i in range(8):
        e.where(batch == i).write.mode("append").parquet(f"{folder}/in")
    last = e.agg(F.lit(None).cast(e.schema["user_id"].dataType).alias("user_id"), (F.max("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(3 * lateness))).alias("ts"))
    last.where("ts IS NOT NULL").write.mode("append").parquet(f"{folder}/in")
    rows = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", e.rdd.getNumPartitions()).parquet(f"{folder}/in")
    run_once(sessions_of(rows, "user_id", "ts", 43_200_000_000, f"{lateness} seconds"), f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out").select("user_id", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"), "n")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'retired' ELSE 'active' END AS status, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS name,
    nullif(concat_ws('|', CASE WHEN p_size % 2 = 0 THEN p_brand END, CASE WHEN p_size % 3 = 0 THEN p_type END), '') AS alt FROM part""")
def element_fields(t):
    k = F.col("p_partkey")
    alt = X.compact(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")), F.when(F.col("p_size") % 3 == 0, F.col("p_type")))
    return t("part").select("p_partkey", E.status_of(F.when(k % 6 == 0, "x").otherwise("cn")).alias("status"), X.null_if_blank(F.when(k % 8 == 0, " ").when(k % 4 == 0, ".").otherwise(F.col("p_name"))).alias("name"), F.array_join(alt, "|").alias("alt"))
