"""Member sources: the snapshot built from the order tables (S4), file readers
(S1, S2), fingerprint (S3) and deterministic exact-size sampling (S15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_scan(df: DataFrame) -> DataFrame:
    """For CPU-heavy per-row work (regex chains, what-if search) straight off
    a scan: the rows are dealt over all cores by a hash of the row. The number
    of input splits does not tell how many tasks get rows: a row group is read
    whole by one task, so of many splits of a file with one row group all but
    one are empty."""
    n = df.rdd.getNumPartitions()  # a scan: no job runs, only file listing
    return df.repartition(max(n, 4 * df.sparkSession.sparkContext.defaultParallelism), F.xxhash64(*df.columns))


def member_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with at least one order before the cut.

    Plan: every table is scanned once. lineitem is pre-aggregated to one count
    per order (map-side partial aggregation, so the shuffle carries one row per
    order, not per line) and meets orders on the unique order key; orders are
    folded per customer with conditional aggregates in a single pass, then
    joined 1:1 to customer. A customer holding a huge share of orders only hits
    the partial aggregation, which is combined map-side before the shuffle.
    """
    cut = F.lit(S.SNAPSHOT_CUT).cast("timestamp_ntz")
    hist = F.lit(S.HISTORY_START).cast("timestamp_ntz")
    cur = F.lit(S.CURRENT_START).cast("timestamp_ntz")

    day = F.col("o_orderdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    lines = (read_table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines")))
    per_cust = (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
                .groupBy("o_custkey")
                .agg(F.count_if(day < cut).alias("n_before"),
                     # Exact decimal sum: the same value whatever the summation order.
                     F.sum(F.when(day < cut, F.col("o_totalprice").cast("decimal(18,2)"))).alias("price_before"),
                     F.count_if(day >= cut).alias("n_after"),
                     F.sum(F.when((day >= hist) & (day < cut), F.col("n_lines"))).alias("lines_hist"),
                     F.sum(F.when((day >= hist) & (day < cut), F.when(day >= cur, F.col("n_lines")).otherwise(0))).alias("lines_cur"))
                .filter(F.col("n_before") > 0))

    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    contract = F.when(k % 9 < 5, 1).when(k % 9 < 7, 6).otherwise(12)
    m = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "inner")
    return m.select(
        k.alias("customer_id"),
        (k % 2).cast("int").alias("gender"),
        (F.col("c_nationkey") % 5 != 0).cast("int").alias("Near_Location"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("int").alias("Partner"),
        (k % 10 < 3).cast("int").alias("Promo_friends"),
        (k % 10 != 9).cast("int").alias("Phone"),
        contract.cast("int").alias("Contract_period"),
        ((k + F.col("c_nationkey")) % 5 < 2).cast("int").alias("Group_visits"),
        (18 + k % 24).cast("int").alias("Age"),
        (F.col("price_before").cast("double") / F.col("n_before").cast("double") / F.lit(2000.0)).alias(
            "Avg_additional_charges_total"),
        F.when(contract == 1, F.lit(1.0))
        .when(contract == 6, (1 + k % 6).cast("double"))
        .otherwise((1 + k % 12).cast("double")).alias("Month_to_end_contract"),
        F.floor((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(1000.0)).cast("int").alias("Lifetime"),
        (F.coalesce(F.col("lines_hist"), F.lit(0)).cast("double") / F.lit(12.0)).alias("Avg_class_frequency_total"),
        (F.coalesce(F.col("lines_cur"), F.lit(0)).cast("double") / F.lit(3.0)).alias(
            "Avg_class_frequency_current_month"),
        (F.col("n_after") == 0).cast("int").alias("Churn"),
    )


def read_members(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Fixed-schema member file, failing fast on malformed rows."""
    r = spark.read.schema(S.MEMBER)
    if fmt == "csv":
        return r.option("header", True).option("mode", "FAILFAST").csv(path)
    return r.format(fmt).load(path)


def read_untrusted_csv(spark: SparkSession, path: str, header: bool = True, schema=S.MEMBER) -> tuple[DataFrame, DataFrame]:
    """The upload path: a ``.csv`` file, or a folder of any number of them. Returns (good rows, rejected lines); a
    rejected row has ``line``, ``file`` and ``reasons``, which say for every field what is wrong with it, or that their
    number is. Lines are read as text and parsed by expressions, so nothing is written or read twice to tell the two
    apart; a line break within quotes is not supported. With ``header`` each file's header line (the column names) is
    left out, wherever it stands; blank lines are too. Null is an empty field."""
    for name in _file_names(spark, path):
        if not name.lower().endswith(".csv"):
            raise ValueError(f"only .csv files are accepted: {name}")
    fields = schema.fields
    raw = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"))
    raw = raw.where(F.trim("line") != "")
    if header:
        raw = raw.where(F.lower(F.regexp_replace("line", r"[\s\"]", "")) != ",".join(f.name.lower() for f in fields))
    parts = F.transform(F.split(F.regexp_replace("line", "\r$", ""), ",", -1), lambda c: F.regexp_replace(F.trim(c), r'^"(.*)"$', "$1"))
    # Behind a generator, so that filters on the fields do not split the line anew for each of them.
    cut = raw.select("line", "file", F.explode(F.array(parts)).alias("_c")).withColumn("_n", F.size("_c"))
    value = lambda i: F.when(F.get("_c", F.lit(i)) != "", F.get("_c", F.lit(i)))
    reasons = [F.when(F.col("_n") != len(fields), F.concat(F.lit(f"{len(fields)} fields expected, not "), F.col("_n").cast("string")))]
    reasons += [F.when((F.col("_n") == len(fields)) & value(i).isNotNull() & value(i).try_cast(f.dataType).isNull(),
                       F.concat(F.lit(f"{f.name}: not {f.dataType.simpleString()}: "), value(i))) for i, f in enumerate(fields)]
    told = cut.withColumn("reasons", F.array_compact(F.array(*reasons)))
    good = told.where(F.size("reasons") == 0).select(*[value(i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])
    return good, told.where(F.size("reasons") > 0).select("line", "file", "reasons")


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(uri, length) of the files that a path, folder or pattern names; hidden ones and Spark's markers left out."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out, todo = [], list(fs.globStatus(p) or [])
    while todo:
        st = todo.pop()
        if st.isDirectory():
            todo += list(fs.listStatus(st.getPath()))
        elif not st.getPath().getName().startswith(("_", ".")):
            out.append((st.getPath().toString(), st.getLen()))
    return sorted(out)


def _file_names(spark: SparkSession, path: str) -> list[str]:
    return [uri.rsplit("/", 1)[-1] for uri, _ in _files(spark, path)]


#: Bytes of a leaf of a file's hash tree, and children of an inner node.
RANGE_BYTES, FAN = 8 << 20, 1024


def dataset_fingerprint(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """S3: a digest per file and one of the whole, rows (file, sha256, length), the last named ``__dataset__``.

    A file is a hash tree over byte ranges: leaves are the SHA-256 of ``range_bytes`` bytes each, every ``FAN`` digests in
    a row (as hex text) are hashed to one, until one is left. A file of one range has the plain SHA-256 of its bytes. The
    ranges of all files are spread over the tasks, each reads its own bytes, so size is no limit. ``__dataset__`` is the
    SHA-256 of the files' digests in ascending order: the same whatever the files are called and in whatever order they
    lie. The driver handles the list of files, not their content."""
    files = _files(spark, path)
    rows = spark.createDataFrame([(u, n) for u, n in files] or [], "uri string, length long")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("length") - 1) / range_bytes), F.lit(0)).cast("long")))
    ranges = rows.select("uri", "length", starts.alias("i")).repartition(max(1, sum(n for _, n in files) // range_bytes + len(files)) if files else 1, "uri", "i")

    def hashed(batches):
        import hashlib

        from pyarrow import fs
        for pdf in batches:
            out = []
            for uri, length, i in zip(pdf["uri"], pdf["length"], pdf["i"]):
                system, where = fs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file://") else "file://" + uri[5:])
                h, left = hashlib.sha256(), min(range_bytes, length - i * range_bytes)
                with system.open_input_file(where) as f:
                    f.seek(i * range_bytes)
                    while left > 0:
                        data = f.read(min(left, 1 << 20))
                        if not data:
                            raise OSError(f"{uri} ends before its length of {length}")
                        h.update(data)
                        left -= len(data)
                out.append(h.hexdigest())
            yield pdf.assign(digest=out)

    nodes = ranges.mapInPandas(hashed, "uri string, length long, i long, digest string")
    most = max([n for _, n in files], default=0)
    levels, width = 0, -(-most // range_bytes)
    while width > 1:
        levels, width = levels + 1, -(-width // FAN)
    joined = lambda column: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x.digest), "")
    for _ in range(levels):  # a file that has one node left keeps it
        grouped = nodes.groupBy("uri", "length", F.floor(F.col("i") / FAN).alias("j")).agg(joined("digest").alias("all"), F.count(F.lit(1)).alias("n"), F.first("digest").alias("only"))
        nodes = grouped.select("uri", "length", F.col("j").alias("i"), F.when((F.col("n") == 1) & (F.col("j") == 0), F.col("only")).otherwise(F.sha2("all", 256)).alias("digest"))
    per = nodes.select(F.element_at(F.split("uri", "/"), -1).alias("file"), F.col("digest").alias("sha256"), "length")
    whole = per.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256).alias("sha256"),
                    F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("length"))
    return per.unionByName(whole.withColumn("file", F.lit("__dataset__")))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """S3 for tables: n_rows and an order-insensitive ``digest``: the sum over the rows of 60 bits of the md5 of the row's
    text (every column as its length, ``:`` and text, ``-`` for null; doubles by their bits), as a decimal string. One
    partially aggregated pass; digests of parts of a table add up to the table's."""
    from ..operators.quantiles import order_bits
    text = lambda c, kind: (order_bits(F.col(f"`{c}`").cast("double")) if kind in ("double", "float") else F.col(f"`{c}`")).cast("string")
    parts = [F.coalesce(F.concat(F.length(text(c, k)).cast("string"), F.lit(":"), text(c, k)), F.lit("-")) for c, k in df.dtypes]
    row_hash = F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("digest"))


def sample_rows(df: DataFrame, n: int, seed: int = S.SEED, key: str = "customer_id") -> DataFrame:
    """Exact-size deterministic sample: the n rows with the smallest
    md5(key || seed), ties on key. A top-n (TakeOrdered) with one bounded
    buffer of n rows per task, no global sort; n is the feature's own limit."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
