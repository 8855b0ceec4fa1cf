"""Silver-shaped tables derived from the benchmark's TPC-H-like tables.

Mapping: an order is one sitting (test result), a customer is a person with
up to three taker ids, a nation is an organization, a part is a question and
a line item is one question response. Orders of one taker on one test are its
numbered attempts; some sittings have no taker and some takers no e-mail. Dates move forward 28 years (leap days preserved) so
they fall in the views' 2020-2099 window. Several keys get an older
snapshot (``load_date`` 2030-01-01) next to the current one (2030-01-08),
which is what the keep-latest deduplication works against.

Everything is a projection, an ``explode`` of the two snapshot dates, a
distinct or a per-order aggregate: the work grows linearly with the input
tables and partitions like them. The derivation is stated portably in
FIXTURES.md section 6; the DuckDB oracle uses that text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examlytics.sources.silver import Silver

# The two snapshot dates of the derived silver tables.
OLD_LOAD = "2030-01-01"
NEW_LOAD = "2030-01-08"
# Newest load of the tables that were last loaded earlier.
NEWEST = {"organization": "2030-01-07", "question": "2030-01-06", "test": "2030-01-05", "category": "2030-01-04"}

# Fixed value: an older result with one answered question.
OLD_RESULT = '[{"questionId":"q-1","score":4,"scored":1,"idleTime":7,"isAnswered":true,"isAnswerCorrect":true}]'

# The level of a test by its priority digit (1 to 5).
TEST_LEVELS = ("easy", "Beginner", "Intermediate", "Advanced", "hard")

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _snapshots(df: DataFrame, keep_old: Column | None, reloaded: Column | None = None, newest: str = NEW_LOAD,
               changed: dict[str, Column] | None = None, again_changed: dict[str, Column] | None = None) -> DataFrame:
    """One row per snapshot date; the old one only where ``keep_old``, the new one twice where ``reloaded``.

    ``changed`` gives columns another value in the old snapshot,
    ``again_changed`` in the second copy of the new one, so that every pick of
    "the latest" shows in the result.
    """
    loads = F.array(F.struct(F.lit(OLD_LOAD).alias("d"), F.lit(0).alias("n")), F.struct(F.lit(newest).alias("d"), F.lit(1).alias("n")),
                    F.struct(F.lit(newest).alias("d"), F.lit(2).alias("n")))
    out = df.withColumn("__load", F.explode(loads))
    old = F.lit(True) if keep_old is None else keep_old
    again = F.lit(False) if reloaded is None else reloaded
    n = F.col("__load.n")
    out = out.where((n == 1) | ((n == 0) & old) | ((n == 2) & again))
    for at, columns in ((0, changed or {}), (2, again_changed or {})):
        out = out.withColumns({c: F.when(n == at, v).otherwise(F.col(c)) for c, v in columns.items()})
    return out.withColumn("load_date", F.col("__load.d")).drop("__load")


def _s(x: Column) -> Column:
    return x.cast("string")


def _shifted_date(ts: str) -> Column:
    """'YYYY-MM-DD' of ``ts`` moved forward 28 years."""
    d = F.col(ts).cast("date").cast("string")
    return F.concat(_s(F.year(ts) + 28), F.substring(d, 5, 6))


def _priority() -> Column:
    return F.substring("o_orderpriority", 1, 1)


def result_json(lineitem: DataFrame) -> DataFrame:
    """Per order, the JSON array of question responses, in line order.

    Groups are one order's lines (bounded). The lines are shuffled as they are,
    since the text of an element is longer than its columns and a partial list
    saves nothing.
    """
    lineitem = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus").repartition("l_orderkey")
    q = F.col("l_quantity").cast("int")
    element = F.concat(
        F.lit('{"questionId":"q-'), _s(F.col("l_partkey")),
        F.lit('","score":'), _s(q),
        F.lit(',"scored":'), _s(F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(q)),
        F.lit(',"idleTime":'), _s(F.col("l_suppkey") % 90),
        F.lit(',"isAnswered":'), F.when(F.col("l_linestatus") == "F", F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"isAnswerCorrect":'), F.when(F.col("l_returnflag") == "A", F.lit("true")).otherwise(F.lit("false")),
        F.lit("}"),
    )
    parts = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", element.alias("e"))))
    return (lineitem.groupBy("l_orderkey")
            .agg(F.concat(F.lit("["), F.array_join(F.transform(parts, lambda x: x["e"]), ","), F.lit("]"))
                 .alias("result")))


def _taker(custkey: Column, group: Column) -> Column:
    return F.concat(F.lit("at-"), _s(custkey), F.lit("-"), _s(group))


def testresult(orders: DataFrame, lineitem: DataFrame | None = None) -> DataFrame:
    k = F.col("o_orderkey")
    start = F.when(k % 101 == 0, F.lit("")).otherwise(F.concat(
        _shifted_date("o_orderdate"), F.lit("T"),
        F.lpad(_s(k % 24), 2, "0"), F.lit(":"), F.lpad(_s(k % 60), 2, "0"), F.lit(":00.000Z")))
    nobody = k % 41 == 5
    # A taker's orders on one test are a handful: the window is bounded by the data's orders per customer.
    nth = F.row_number().over(Window.partitionBy("o_custkey", k % 3, _priority(), k % 2).orderBy(k))
    base = orders.select(
        "o_orderkey",
        F.when(~nobody, _taker(F.col("o_custkey"), k % 3)).alias("assessmenttakerid"),
        F.concat(F.lit("t-"), _priority(), _s(k % 2)).alias("testid"),
        F.when(nobody, k).otherwise(nth).cast("long").alias("attemptnumber"),
        F.concat(F.lit("Test "), _priority()).alias("title"),
        start.alias("starttime"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("2030-01-01T00:00:00.000Z")).alias("finishtime"),
        (k % 3600).cast("long").alias("duration"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("testpercentage"),
        F.when(F.col("o_totalprice") >= 250000, F.lit("PASS")).otherwise(F.lit("fail")).alias("passstatus"),
        F.when(k % 50 == 7, F.lit(None).cast("long")).otherwise((k % 9).cast("long"))
        .alias("testwindowviolationcount"),
        ((k % 9) * 15).cast("long").alias("testwindowviolationduration"),
        (k % 21).cast("long").alias("numberofquestions"),
        ((k % 21).cast("long") - (k % 7).cast("long") * (k % 21 >= 6).cast("int"))
        .alias("numberofquestionsfailed"),
        F.greatest(k % 21 - k % 3, F.lit(0)).cast("long").alias("numberofquestionsanswered"),
        F.lit("done").alias("status"),
        (k % 4).cast("long").alias("testtakershotcount"),
    )
    if lineitem is not None:
        base = base.join(result_json(lineitem), base.o_orderkey == F.col("l_orderkey"), "left").drop("l_orderkey")
    else:
        base = base.withColumn("result", F.lit(None).cast("string"))
    key, old_start = F.col("o_orderkey"), F.when(k % 3 == 0, F.lit("1999-01-01T00:00:00.000Z")).otherwise(F.lit("2024-06-01T08:30:00.000Z"))
    # The newest result is unusable for some sittings whose older one is not.
    base = base.withColumn("result", F.when(k % 35 == 0, F.lit("[]")).otherwise(F.col("result"))).withColumn("__result", F.when((k % 35 == 0) | (k % 25 == 0), F.lit(OLD_RESULT)).otherwise(F.col("result")))
    return _snapshots(base, key % 5 == 0, key % 13 == 0, changed={
        "starttime": old_start, "testpercentage": (100 - F.col("testpercentage")).cast("int"), "duration": F.col("duration") + 60,
        "passstatus": F.when(F.col("passstatus") == "PASS", F.lit("fail")).otherwise(F.lit("PASS")),
        "testwindowviolationcount": F.lit(8).cast("long"), "numberofquestionsfailed": F.lit(0).cast("long"), "result": F.col("__result"),
    }, again_changed={
        "finishtime": F.when(key % 2 == 0, F.lit("2030-01-03T00:00:00.000Z")).otherwise(F.lit("2029-12-31T00:00:00.000Z")),
        "testpercentage": (F.col("testpercentage") + 1).cast("int"), "duration": F.col("duration") + 30,
    }).drop("o_orderkey", "__result")


def assessmenttaker(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per (customer, order key modulo 3), described by its smallest order."""
    m, c = F.col("m"), F.col("o_custkey")
    takers = orders.groupBy("o_custkey", (F.col("o_orderkey") % 3).alias("g")).agg(
        F.min("o_orderkey").alias("m"), F.min("o_orderdate").alias("since"))
    suffix = (F.when(c % 3 == 0, F.lit("@corp.example"))
              .when(c % 97 == 1, F.lit("")).otherwise(F.lit("@ext.example")))
    tags = (F.when(m % 5 == 0, F.lit('["2025 National Service Personnel","Frontend"]'))
            .when(m % 5 == 1, F.lit('["CDC December 2025","Aptitude"]'))
            .when(m % 5 == 2, F.lit("[]"))
            .when(m % 5 == 3, F.lit("not json")))
    base = (takers.join(customer, takers.o_custkey == customer.c_custkey)
            .select("m", _taker(c, F.col("g")).alias("id"),
                    F.when(c % 89 != 3, F.concat(F.lit("user."), _s(c), suffix)).alias("email"),
                    F.concat(F.lit("as-"), _s(m % 50)).alias("assessmentid"),
                    F.concat(F.lit("org-"), _s(F.col("c_nationkey"))).alias("organizationid"),
                    F.concat(F.lit("d-"), _s(m % 200)).alias("dispatchid"),
                    tags.alias("tags"),
                    _shifted_date("since").alias("createdat"),
                    (m % 2 == 0).alias("showresults"), F.lit("").alias("starttime")))
    return _snapshots(base, m % 4 == 0, changed={
        "email": F.concat(F.lit("old."), _s(m), F.lit("@corp.example")), "assessmentid": F.concat(F.lit("as-"), _s((m + 1) % 50)),
        "organizationid": F.lit("org-1"), "dispatchid": F.concat(F.lit("d-"), _s((m + 60) % 200)), "tags": F.lit('["2024 Data Batch"]'),
    }).drop("m")


def organization(nation: DataFrame) -> DataFrame:
    base = nation.where(F.col("n_nationkey") != 7)
    out = _snapshots(base, None, newest=NEWEST["organization"])
    return out.select(
        F.concat(F.lit("org-"), _s(F.col("n_nationkey"))).alias("id"),
        F.concat(F.col("n_name"), F.when(F.col("load_date") == OLD_LOAD, F.lit(" (old)")).otherwise(F.lit("")))
        .alias("organizationname"),
        "load_date")


def test(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        F.concat(F.lit("t-"), _priority(), _s(k % 2)).alias("id"),
        F.concat(F.lit("Test "), _priority()).alias("title"),
        F.element_at(F.array(*map(F.lit, TEST_LEVELS)), _priority().cast("int")).alias("difficultylevel"),
        F.concat(F.lit("dom-"), _priority()).alias("domainid"),
        F.concat(F.lit("org-"), _priority()).alias("organizationid"),
        F.lit("text").alias("description"), F.lit(False).alias("system")).distinct().transform(lambda t: _snapshots(
            t, None, newest=NEWEST["test"], changed={"title": F.lit("Renamed"), "difficultylevel": F.lit("Intermediate"), "domainid": F.lit("dom-3")}))


def domain(orders: DataFrame) -> DataFrame:
    p = _priority()
    name = (F.when(p == "1", F.lit("Backend Engineering 1781523206632"))
            .when(p == "2", F.lit("data engineering"))
            .when(p == "3", F.lit("Aptitude"))
            .when(p == "4", F.lit("AWS_99887766 x"))
            .otherwise(F.lit("Unlisted Domain")))
    return orders.select(F.concat(F.lit("dom-"), p).alias("id"), name.alias("name"), F.lit(False).alias("system")
                         ).distinct().transform(lambda t: _snapshots(t, None, changed={"name": F.lit("Aptitude")}))


def dispatch(orders: DataFrame) -> DataFrame:
    m = F.col("o_orderkey") % 200
    tags = (F.when(m.between(0, 49), F.lit("[]"))
            .when(m.between(50, 79), F.lit('["IT Skill Batch 2026"]')))
    return orders.select(
        F.concat(F.lit("d-"), _s(m)).alias("id"), tags.alias("tags"),
        F.when(m >= 100, F.lit("2027-03-01")).alias("commencedate"),
        (m % 2 == 0).alias("showResults"), F.lit("link").alias("dispatchLink"),
        F.lit("2026-11-05").alias("createdat")).distinct().transform(lambda t: _snapshots(
            t, None, changed={"tags": F.lit('["CDC Batch 2023"]'), "commencedate": F.lit("2023-01-01")}))


def question(part: DataFrame) -> DataFrame:
    pk, size = F.col("p_partkey"), F.col("p_size")
    text = F.when(pk % 10 == 0, F.lit("")).otherwise(F.concat(
        F.lit("<p>What is <b>"), F.col("p_name"), F.lit("</b>?<br/>A&nbsp;&amp;&nbsp;B</p>")))
    base = part.select(
        "p_partkey",
        F.concat(F.lit("q-"), _s(pk)).alias("id"),
        F.concat(F.lit("trainer-"), _s(size % 9)).alias("creator"),
        F.when(size % 4 != 0, F.concat(F.lit("v-"), _s(pk))).alias("activeversionid"),
        _s(size * 2).alias("calibrationscore"),
        F.when(size % 3 == 0, F.lit("draft")).otherwise(F.lit("active")).alias("status"),
        F.when(size % 3 == 0, F.lit("easy")).when(size % 3 == 1, F.lit("medium")).otherwise(F.lit("hard"))
        .alias("difficultylevel"),
        F.concat(F.lit("org-"), _s(pk % 25)).alias("organizationid"),
        F.concat(F.lit("cat-"), F.col("p_type")).alias("categoryid"),
        F.concat(F.lit("dom-"), _s(pk % 6)).alias("domainid"),
        F.when(pk % 2 == 0, F.lit("mcq")).otherwise(F.lit("code")).alias("questiontype"),
        F.col("p_name").alias("questiontitle"),
        text.alias("questiontext"), F.md5(F.col("p_name")).alias("hash"))
    return _snapshots(base, pk % 2 == 0, newest=NEWEST["question"], changed={
        "creator": F.lit("trainer-old"), "status": F.lit("draft"), "calibrationscore": F.lit("1"), "difficultylevel": F.lit("easy"),
        "categoryid": F.lit("cat-ECONOMY"), "domainid": F.lit("dom-2"), "questiontitle": F.lit("old title"), "questiontext": F.lit("<p>Old</p>"),
    }).drop("p_partkey")


def category(part: DataFrame) -> DataFrame:
    t = F.col("p_type")
    name = (F.when(t == "ECONOMY", F.lit("Node")).when(t == "MEDIUM", F.lit("React 1234567"))
            .when(t == "SMALL", F.lit("Cypress")).otherwise(t))
    return part.select(F.concat(F.lit("cat-"), t).alias("id"), name.alias("name"), F.lit("about").alias("description"), F.lit(False).alias("system")
                       ).distinct().transform(lambda c: _snapshots(c, None, newest=NEWEST["category"], changed={"name": F.lit("Cypress")}))


def assessment(orders: DataFrame) -> DataFrame:
    m = F.col("o_orderkey") % 50
    return orders.select(
        F.concat(F.lit("as-"), _s(m)).alias("id"),
        F.concat(F.lit("org-"), _s(m % 25)).alias("organizationid"),
        (m % 4 != 0).alias("isdispatched"),
        F.concat(F.lit("Assessment "), _s(m)).alias("title"),
        F.when(m % 3 == 0, F.lit("draft")).otherwise(F.lit("published")).alias("status"),
        F.when(m % 7 != 0, ((m + 1) * 60).cast("long")).alias("duration"),
        F.lit("read first").alias("instructions")).distinct().transform(lambda a: _snapshots(
            a, None, changed={"title": F.lit("Untitled"), "status": F.lit("new"), "organizationid": F.lit("org-2"), "isdispatched": F.lit(False)}))


def question_flags(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Flags of questions that takers raised; an older snapshot names another taker."""
    first = (lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
             .groupBy("l_orderkey").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s")))
    o = F.col("o_orderkey")
    flags = first.join(orders, F.col("l_orderkey") == o).select(
        "l_orderkey", F.concat(F.lit("f-"), _s(o)).alias("id"), F.concat(F.lit("q-"), _s(F.col("p"))).alias("questionid"),
        _taker(F.col("o_custkey"), o % 3).alias("assessmenttakerid"), F.concat(F.lit("org-"), _s(F.col("s") % 25)).alias("organizationid"),
        F.lit("text").alias("questiontext"))
    return _snapshots(flags, F.col("l_orderkey") % 3 == 0, changed={"assessmenttakerid": F.lit("at-1-0")}).drop("l_orderkey")


def skills(part: DataFrame) -> DataFrame:
    """Skills, one per part type (a table only the gold transforms read)."""
    t = F.col("p_type")
    return part.select(F.concat(F.lit("skill-"), t).alias("id"), t.alias("name"), F.lit("org-1").alias("organizationid"),
                       F.lit(True).alias("system"), F.lit("about").alias("description"), F.lit("[]").alias("tags"),
                       F.lit(NEW_LOAD).alias("load_date")).distinct()


def silver_from_driver(spark: SparkSession, sf_dir: str) -> Silver:
    """All silver tables, derived lazily from ``sf_dir``'s parquet files."""
    orders = read_table(spark, sf_dir, "orders")
    return Silver(
        testresult=testresult(orders, read_table(spark, sf_dir, "lineitem")),
        assessmenttaker=assessmenttaker(orders, read_table(spark, sf_dir, "customer")),
        dispatch=dispatch(orders),
        test=test(orders),
        assessment=assessment(orders),
        question=question(read_table(spark, sf_dir, "part")),
        category=category(read_table(spark, sf_dir, "part")),
        domain=domain(orders),
        organization=organization(read_table(spark, sf_dir, "nation")),
        questionflag=question_flags(read_table(spark, sf_dir, "lineitem"), orders),
    )
