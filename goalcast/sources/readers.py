"""File sources: header (S1), sparse rows (S2, S3 gzip by extension), raw `$` log (S4),
parameter files (S5), forest prediction files (S6), Bayes model tables (S7),
hyper-parameter grids (S8).

All readers are Spark readers over folders (local, HDFS or object store paths);
the only per-file whole-text reads are for formats whose meaning depends on line
position inside one file (parameter files, prediction files, label totals), and
those files are written one per bounded unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goalcast.constants import KNOWN_LABELS, OTHER, RAW_NULL_TOKENS
from goalcast.functions.columns import strip_ws

PARTS = "part-*"


def _jvm_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def validate_parts(spark: SparkSession, path: str, expected: int | None = None) -> int:
    """Folder must exist, be a folder and hold ``part-*`` files (exactly ``expected``
    of them when given); only file metadata is listed."""
    p, fs = _jvm_path(spark, path)
    if not fs.exists(p):
        raise OSError(f"Path does not exist: {path}")
    if not fs.getFileStatus(p).isDirectory():
        raise OSError(f"Path is not a directory: {path}")
    n = len([s for s in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + PARTS))])
    if n == 0:
        raise OSError(f"No files of form {PARTS} found inside: {path}")
    if expected is not None and n != expected:
        raise OSError(f"Amount of parts doesn't match what was expected. actual: {n}, expected:{expected}, {path}")
    return n


def read_header(spark: SparkSession, path: str, delimiter: str = "\t",
                labels: list[str] = KNOWN_LABELS) -> DataFrame:
    """(idx, name, is_label) from the first line of the single part file."""
    validate_parts(spark, path, expected=1)
    txt = spark.read.text(path, wholetext=True, pathGlobFilter=PARTS)
    first = F.element_at(F.split(F.col("value"), "\n"), 1)
    names = F.split(strip_ws(first), delimiter if delimiter != "|" else "[|]")
    out = txt.select(F.posexplode(names).alias("idx", "name"))
    return out.select(F.col("idx").cast("int"), "name", F.col("name").isin(labels).alias("is_label"))


def read_sparse(spark: SparkSession, header: DataFrame, path: str, delimiter: str = "\t") -> DataFrame:
    """(row_id, features array<int>, <label columns>) from tab-separated index lines.

    Any token that is not an integer drops the whole row (so does an empty line);
    indices up to the last feature index are features, a label is 1 when its index
    is present, higher unknown indices are ignored. ``.gz`` parts are decompressed
    by the text source. The header is tiny: its two numbers reach the driver.
    """
    validate_parts(spark, path)
    h = header.where(~F.col("is_label"))
    last = h.agg(F.max("idx")).collect()[0][0]
    label_idx = {r["name"]: r["idx"] for r in header.where(F.col("is_label")).collect()}
    lines = spark.read.text(path, pathGlobFilter=PARTS)
    toks = F.split(strip_ws(F.col("value")), delimiter)
    idx = F.transform(toks, lambda t: t.try_cast("int"))
    parsed = lines.select(idx.alias("_idx")).where(~F.exists("_idx", lambda x: x.isNull()))
    feats = F.array_sort(F.array_distinct(F.filter("_idx", lambda x: x <= F.lit(last))))
    labs = [F.array_contains("_idx", F.lit(i)).cast("int").alias(n) for n, i in label_idx.items()]
    missing = [F.lit(0).alias(n) for n in KNOWN_LABELS if n not in label_idx]
    return parsed.select(F.monotonically_increasing_id().alias("row_id"), feats.alias("features"), *labs, *missing)


def load_data_group(spark: SparkSession, header_path: str, set_paths: dict[str, str],
                    delimiter: str = "\t") -> tuple[DataFrame, DataFrame]:
    """The named sets of one header as one table ``(row_id, set, features, <labels>)``,
    and the header. Row ids are given while reading and written with the rows in the shared
    folder, so later jobs (and retries) see the same ids; ids of different sets differ in
    their set."""
    from goalcast.session import cut_lineage
    header = read_header(spark, header_path, delimiter)
    parts = [read_sparse(spark, header, p, delimiter).withColumn("set", F.lit(name)) for name, p in set_paths.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return cut_lineage(rows.select("row_id", "set", "features", *KNOWN_LABELS), "data-group"), header


def normalise_nulls(df: DataFrame, tokens: list[str] = RAW_NULL_TOKENS) -> DataFrame:
    """Null tokens -> null, in one projection (the CSV reader takes a single null token)."""
    return df.select(*[F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
                       for c in df.columns])


def read_raw_log(spark: SparkSession, data_path: str, header_path: str) -> DataFrame:
    """`$`-separated log, every column a string, names from the header CSV. A field in
    double quotes may hold the separator; a doubled quote inside it is one quote."""
    from pyspark.sql.types import StringType, StructField, StructType
    head = spark.read.option("header", "true").csv(header_path)
    schema = StructType([StructField(c, StringType()) for c in head.columns])
    raw = (spark.read.schema(schema).option("sep", "$").option("quote", '"').option("escape", '"')
           .option("nullValue", "\u0001").option("emptyValue", "").csv(data_path))
    return normalise_nulls(raw)


def parse_parameters(lines: DataFrame, lower_values: bool = False) -> DataFrame:
    """S5 on (file, line_no, line): -> (file, key, value, values array, is_list).

    Lines are stripped, blanks skipped; the first ``=`` splits key and value; a
    double-quoted value is a list split on ``,`` with single quotes stripped per item;
    otherwise single quotes are stripped; empty -> null; last duplicate key wins.
    A line without ``=`` raises (its line number is reported)."""
    s = lines.select("file", "line_no", strip_ws(F.col("line")).alias("line")).where(F.col("line") != "")
    bad = s.where(~F.col("line").contains("=")).agg(F.min("line_no")).collect()[0][0]  # one row
    if bad is not None:
        raise ValueError(f"Failed parsing properties on line {bad + 1}")
    key = F.regexp_extract("line", r"^(.*?)=(.*)$", 1)
    val = F.regexp_extract("line", r"^(.*?)=(.*)$", 2)
    s = s.select("file", "line_no", key.alias("key"), val.alias("raw"))
    is_list = F.col("raw").startswith('"') & F.col("raw").endswith('"') & (F.length("raw") >= 2)
    inner = F.substring(F.col("raw"), 2, F.length("raw") - 2)
    strip_q = lambda c: F.when(c.startswith("'") & c.endswith("'") & (F.length(c) >= 2),
                               F.substring(c, 2, F.length(c) - 2)).otherwise(c)
    items = F.transform(F.split(inner, ",", -1), strip_q)
    single = strip_q(F.col("raw"))
    if lower_values:
        items = F.transform(items, F.lower)
        single = F.lower(single)
    s = s.select("file", "line_no", "key", is_list.alias("is_list"),
                 F.when(is_list, items).otherwise(F.array(single)).alias("values"))
    s = s.withColumn("values", F.when((~F.col("is_list")) & (F.col("values")[0] == ""), F.lit(None)).otherwise(F.col("values")))
    last = s.groupBy("file", "key").agg(F.max_by(F.struct("values", "is_list"), "line_no").alias("_v"))
    return last.select("file", "key", F.col("_v.values").alias("values"), F.col("_v.is_list").alias("is_list"))


def read_parameter_files(spark: SparkSession, path: str, lower_values: bool = False,
                         pattern: str = "*arameters*") -> DataFrame:
    """S5 over many parameter files (each small): one whole-text row per file."""
    txt = (spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
           .select(F.input_file_name().alias("file"), "value"))
    lines = txt.select("file", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return parse_parameters(lines, lower_values)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Forest prediction files -> (file, row, prob, pred).

    Line 1 is a comment, line 2 the class header (position of token ``1`` is the
    positive column), line 3 blank, then one row per sample. Without a ``1`` column
    every probability is 0.0; pred = 1 iff prob > 0.5.

    Files are read as lines and may be split: a line's number is its place in its block
    plus the lines of the earlier blocks of its file (a table of one row per block)."""
    from pyspark.sql import Window

    from goalcast.session import cut_lineage
    block = ["file", "start"]
    lines = cut_lineage(
        spark.read.text(path, recursiveFileLookup=True)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("place"), strip_ws(F.col("value")).alias("line")), "prediction-lines")
    blocks = lines.groupBy(*block).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")
    blocks = blocks.withColumn("before", before).drop("n")      # one row per file block
    numbered = lines.join(blocks, block).select("file", "line", (F.col("before") + F.col("place") - F.col("first")).alias("no"))
    heads = numbered.where("no = 1").select("file", F.array_position(F.split("line", r"\s+"), "1").alias("pos"))
    body = numbered.where((F.col("no") >= 3) & (F.col("line") != ""))
    prob = F.when(F.col("pos") > 0, F.try_element_at(F.split("line", r"\s+"), F.col("pos").cast("int")).try_cast("double")) \
            .otherwise(F.lit(0.0))
    return body.join(heads, "file").select("file", (F.col("no") - 3).cast("int").alias("row"), prob.alias("prob"),
                                           (prob > 0.5).cast("int").alias("pred"))


def read_bayes_model(spark: SparkSession, path: str, prefix: str = "historical") -> dict | None:
    """Model folder with ``index``, ``<prefix>/positive_counts``,
    ``<prefix>/negative_counts``, ``<prefix>/label_counts``; blank lines skipped.
    Returns None when the prefix folder is absent. Keys = positive keys ∪ negative
    keys (full outer join), missing counts 0."""
    p, fs = _jvm_path(spark, f"{path}/{prefix}")
    if not fs.exists(p):
        return None

    def counts(name):
        t = spark.read.text(f"{path}/{prefix}/{name}").where(strip_ws(F.col("value")) != "")
        c = F.split(strip_ws(F.col("value")), "\t")
        k = F.split(c[0], ",")
        return t.select(k[0].cast("int").alias("i"), F.coalesce(k[1], k[0]).cast("int").alias("j"),
                        c[1].cast("long").alias("c"))
    pos = counts("positive_counts").withColumnRenamed("c", "pos")
    neg = counts("negative_counts").withColumnRenamed("c", "neg")
    keys = pos.join(neg, ["i", "j"], "full_outer").select(
        "i", "j", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
    # two lines (positive, negative) in one small file
    lc = [r_[0] for r_ in spark.read.text(f"{path}/{prefix}/label_counts", wholetext=True).collect()]
    lc_lines = [x for t in lc for x in t.split("\n") if x.strip()]
    totals = {"pos": int(lc_lines[0].split("\t")[1]), "neg": int(lc_lines[1].split("\t")[1])}
    index = spark.read.text(f"{path}/index").where(strip_ws(F.col("value")) != "")
    ic = F.split(strip_ws(F.col("value")), "\t")
    index = index.select(ic[0].alias("name"), ic[1].cast("int").alias("idx"))
    return {"keys": keys, "totals": totals, "index": index}


def read_grid(spark: SparkSession, path: str, order: list[str] | None = None) -> DataFrame:
    """Hyper-parameter JSON (name -> list of options) -> one row per configuration:
    the cartesian product by one ``posexplode`` per parameter on the single grid row;
    ``config_id`` numbers configurations in product order of ``order`` (the file's key
    order; the JSON reader itself sorts keys). An empty space -> one empty configuration."""
    g = spark.read.option("multiLine", "true").json(path)
    names = [c for c in (order or g.columns) if c in g.columns and c != "_corrupt_record"]
    if not names:
        return spark.range(1).select(F.lit(0).alias("config_id"))
    df = g.select(*names, *[F.size(c).alias(f"_n_{c}") for c in names])
    for c in names:
        df = df.select("*", F.posexplode(c).alias(f"_p_{c}", f"_v_{c}")).drop(c).withColumnRenamed(f"_v_{c}", c)
    cid = F.lit(0)
    for c in names:
        cid = cid * F.col(f"_n_{c}") + F.col(f"_p_{c}")
    return df.select(cid.cast("int").alias("config_id"), *names)


ZIP_MEMBERS_SCHEMA = "model string, part string, k1 string, k2 string, value string"


def _zip_members(batches):
    """Per zip file (one row of ``binaryFile``): the members ``index``,
    ``<prefix>/positive_counts``, ``<prefix>/negative_counts``, ``<prefix>/label_counts``
    and ``thresholds`` as (model, part, k1, k2, value) rows. A zip is not splittable,
    so each file is read by one task; the rows it yields are distributed afterwards."""
    import io
    import zipfile

    import pandas as pd
    for pdf in batches:
        out = []
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                for member in z.namelist():
                    if member.endswith("/"):
                        continue
                    text = z.read(member).decode("utf-8")
                    lines = [x.strip() for x in text.split("\n") if x.strip()]
                    for n, line in enumerate(lines):
                        cols = line.split("\t")
                        out.append((path, member, cols[0], str(n), "\t".join(cols[1:])))
        yield pd.DataFrame(out, columns=["model", "part", "k1", "k2", "value"])


def read_bayes_zip(spark: SparkSession, path: str, prefix: str = "historical") -> dict:
    """S7 for existing model zips (``binaryFile`` + ``mapInPandas``): same tables as
    ``read_bayes_model`` plus the CR step table, keyed by model file."""
    rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_zip_members, ZIP_MEMBERS_SCHEMA)

    def counts(name):
        t = rows.where(F.col("part") == f"{prefix}/{name}")
        k = F.split("k1", ",")
        return t.select("model", k[0].cast("int").alias("i"), F.coalesce(k[1], k[0]).cast("int").alias("j"),
                        F.col("value").cast("long").alias("c"))
    pos = counts("positive_counts").withColumnRenamed("c", "pos")
    neg = counts("negative_counts").withColumnRenamed("c", "neg")
    keys = pos.join(neg, ["model", "i", "j"], "full_outer").select(
        "model", "i", "j", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
    lc = rows.where(F.col("part") == f"{prefix}/label_counts")
    totals = lc.groupBy("model").agg(
        F.max(F.when(F.col("k2") == "0", F.col("value").cast("long"))).alias("pos"),
        F.max(F.when(F.col("k2") == "1", F.col("value").cast("long"))).alias("neg"))
    index = rows.where(F.col("part") == "index").select("model", F.col("k1").alias("name"), F.col("value").cast("int").alias("idx"))
    th = rows.where(F.col("part") == "thresholds").select(
        "model", F.col("k1").alias("row"), F.transform(F.split("value", "\t"), lambda x: x.cast("double")).alias("values"))
    return {"keys": keys, "totals": totals, "index": index, "thresholds": th}
