"""Lines and documents derived from the star-schema tables, whole tables each.

The checked queries need JSON as the operators meet it: with empty and missing
fields, malformed lines, arrays where a string was expected. These builders
write such JSON from table rows, one row at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.once import evaluate_once
from shelfmark.session import spread

SOURCES = tuple(f"src{i}" for i in range(20))
SOURCE_LANGS = ("de", "en", "es", "fr")
DEV_SOURCES = ("src0", "src5", "src10", "src15")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")


def split_of(source: Column) -> Column:
    return F.when(source.isin(*DEV_SOURCES), F.lit("dev")).otherwise(F.lit("train"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per document, placed like a collection: split, source as document
    type, language. Spanish lines lack their closing brace, French ones under
    500 characters are blank."""
    line = F.to_json(F.struct("doc_id", "text"))
    return spread(table(spark, sf_dir, "documents")).select(
        split_of(F.col("source")).alias("split"),
        F.col("source").alias("doc_type"),
        "lang",
        F.col("source").alias("file"),
        F.lit(0).cast("long").alias("block"),
        F.col("doc_id").alias("line_no"),
        F.when((F.col("lang") == "fr") & (F.col("n_chars") < 500), F.lit(" \t "))
        .when(F.col("lang") == "es", F.rtrim(line, F.lit("}")))
        .otherwise(F.concat(F.lit("  "), line, F.lit(" ")))
        .alias("line"),
    )


def paper_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paper lines of all documents: text given (en), empty with the text as title
    (fr), title only (de), no content (es); no id for one source, a null content
    for another."""
    lang, text = F.col("lang"), F.col("text")
    content = (
        F.when(lang == "en", F.to_json(F.struct("text", F.col("source").alias("title_en"))))
        .when(lang == "fr", F.to_json(F.struct(F.lit("").alias("text"), text.alias("title_en"))))
        .when(lang == "de", F.to_json(F.struct(text.alias("title_en"))))
    )
    paper_id = F.when(F.col("source") == "src3", F.lit("")).otherwise(
        F.concat(F.lit("doc-"), F.col("doc_id"))
    )
    line = F.concat(
        F.lit('{"paper_id":"'),
        paper_id,
        F.lit('"'),
        F.when(F.col("source") == "src4", F.lit(',"content":null'))
        .when(content.isNotNull(), F.concat(F.lit(',"content":'), content))
        .otherwise(F.lit("")),
        F.lit("}"),
    )
    return evaluate_once(spread(table(spark, sf_dir, "documents")), line=line).select(
        "doc_id", split_of(F.col("source")).alias("split"), "line"
    )


def subject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject lines of all parts: definitions null, empty or given by size; one
    brand without a label, one with a blank label."""
    size, brand = F.col("p_size"), F.col("p_brand")
    label = (
        F.when(brand == "Brand#1", F.lit(""))
        .when(brand == "Brand#2", F.lit(" "))
        .otherwise(F.col("p_name"))
    )
    definition = F.when(size >= 20, F.concat_ws(" ", "p_type", "p_brand")).when(size >= 10, F.lit(""))
    line = F.to_json(
        F.struct(
            F.concat(F.lit("part-"), F.col("p_partkey")).alias("Code"),
            label.alias("Classification Name"),
            definition.alias("Definition"),
        )
    )
    return evaluate_once(spread(table(spark, sf_dir, "part")), line=line).select("p_partkey", "line")


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties, spoilt by event type: trailing text, single quotes, cut
    short, wrapped in an array; purchases stay intact."""
    kind, props = F.col("event_type"), F.col("props")
    line = (
        F.when(kind == "error", F.concat(props, F.lit(" trailing")))
        .when(kind == "view", F.translate(props, '"', "'"))
        .when(kind == "click", F.rtrim(props, F.lit("}")))
        .when(kind == "signup", F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(props)
    )
    return evaluate_once(spread(table(spark, sf_dir, "events")), line=line).select("event_id", "line")


def truth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per order whose ``v`` is one of fifteen values, by status
    and priority; the last has no ``v``."""
    values = {
        "F": ["0", "false", '""', "[]", "{}"],
        "O": ["1", "true", '" "', "[0]", '{"a":0}'],
        "P": ["0.0", "null", '"0"', "-0.5", None],
    }
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    line = F.lit(None).cast("string")
    for status, column in values.items():
        for priority, value in zip(priorities, column):
            here = (F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == priority)
            line = F.when(here, F.lit("{}" if value is None else f'{{"v":{value}}}')).otherwise(line)
    return evaluate_once(spread(table(spark, sf_dir, "orders")), line=line).select("o_orderkey", "line")


def _quoted(value: str) -> str:
    return f"to_json(CAST({value} AS VARIANT))"


def _ref(name: str) -> str:
    return f"""concat('{{"@id":', {_quoted(name)}, '}}')"""


def _list(*items: str) -> str:
    return f"concat('[', concat_ws(',', {', '.join(items)}), ']')"


def _member(term: str, value: str) -> str:
    return f"""concat('"{term}":', {value})"""


def _object(*members: str) -> str:
    return f"concat('{{', concat_ws(',', {', '.join(members)}), '}}')"


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-LD document per order: customer, nation and market segment as
    entities, the order as the record. Titles, labels, subjects and creators
    change shape with the order's status, segment and year."""
    orders = spread(table(spark, sf_dir, "orders"))
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    rows = orders.join(customer, "o_custkey").join(nation, "c_nationkey").selectExpr(
        "CAST(o_orderkey AS STRING) AS key",
        "o_orderstatus AS status",
        "o_orderpriority AS priority",
        "year(o_orderdate) AS y",
        "c_mktsegment AS segment",
        "c_name",
        "n_name",
        "CAST(o_custkey AS STRING) AS custkey",
        "concat('cust:', o_custkey) AS cust",
        "concat('nat:', c_nationkey) AS nat",
        "concat('seg:', lower(c_mktsegment)) AS seg",
        "concat_ws(' ', 'Order', o_orderkey, n_name) AS title",
    )
    by_reference = "segment IN ('MACHINERY', 'FURNITURE')"
    record = _object(
        _member("@id", _quoted("concat('https://example.org/id/ORD%3A', key)")),
        _member("@type", """if(status = 'P', '"bibo:Report"', '"bibo:Book"')"""),
        _member("title", f"if(status = 'P', {_list(_quoted('title'), _quoted('priority'))}, {_quoted('title')})"),
        _member("abstract", _quoted("concat_ws(' ', segment, 'of', c_name)")),
        f"if(priority <> '5-LOW', {_member('issued', _quoted('CAST(y AS STRING)'))}, NULL)",
        "if(status <> 'O', "
        + _member("language", _quoted(
            "concat('http://id.loc.gov/vocabulary/iso639-1/', if(segment = 'BUILDING', 'de', 'en'))"
        ))
        + ", NULL)",
        _member("identifier", _list(_quoted("concat('(ppn)', key)"), _quoted("concat('(firstid)ORD:', key)"))),
        _member("subject", f"if(status = 'F', {_quoted('segment')}, " + _list(
            _quoted("concat('(classificationName=prio)', priority)"),
            _quoted("concat('(classificationName=bk, id=', custkey, ')', segment)"),
            _quoted("concat('(other) ', segment)"),
        ) + ")"),
        _member("dcterms:subject", _list(_ref("cust"), _ref("nat"))),
        "if(segment <> 'AUTOMOBILE', "
        + _member("creator", f"if({by_reference}, {_list(_quoted('cust'), _quoted('seg'))}, {_quoted('c_name')})")
        + ", NULL)",
        f"if(status = 'O', {_member('http://purl.org/dc/elements/1.1/creator', _quoted('n_name'))}, NULL)",
        f"if(status = 'P', {_member('dcterms:creator', _ref('nat'))}, NULL)",
        _member("contributor", _list("""'"Clerk"'""", _ref("cust"))),
    )
    creator_term = (
        f"""if({by_reference}, '{{"@id":"http://purl.org/dc/terms/creator","@type":"@id"}}', """
        """'"http://purl.org/dc/elements/1.1/creator"')"""
    )
    context = _object(
        _member("creator", creator_term),
        """'"contributor":"http://purl.org/dc/terms/contributor"'""",
        """'"cust":"http://example.org/customer/","nat":"http://example.org/nation/"'""",
    )

    def entity(name: str, label: str) -> str:
        return _object(_member("@id", _quoted(name)), _member("sameAs", label))

    label = f"if(segment = 'BUILDING', {_list(_quoted('c_name'), _quoted('segment'))}, {_quoted('c_name')})"
    document = _object(
        _member("@graph", _list(
            entity("cust", label),
            entity("nat", _quoted("n_name")),
            entity("seg", _quoted("segment")),
            record,
        )),
        """'"@id":"urn:example:graph"'""",
        _member("@context", context),
    )
    return evaluate_once(rows, value=F.expr(document)).selectExpr(
        "key AS file", "if(y >= 2000, 'dev', 'train') AS split", "value"
    )


def supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-LD document per supplier, the nation as its entity, with the folders that
    it belongs in: split by account, type by nation, language by region."""
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(nation), "s_nationkey")  # 25 nations
    nat = "concat('nat:', s_nationkey)"
    entity = _object(_member("@id", _quoted(nat)), _member("sameAs", _quoted("n_name")))
    record = _object(
        _member("@id", _quoted("concat('https://example.org/id/SUP%3A', s_suppkey)")),
        _member("@type", "'\"bibo:Book\"'"),
        _member("title", _quoted("s_name")),
        _member("dcterms:subject", _ref(nat)),
    )
    return evaluate_once(rows, value=F.expr(_object(_member("@graph", _list(entity, record))))).selectExpr(
        "if(s_acctbal < 0, 'dev', 'train') AS split",
        "if(s_nationkey % 2 = 0, 'Book', 'Report') AS doc_type",
        "if(n_regionkey = 3, 'de', 'en') AS dir_lang",
        "value",
    )
