"""Text queries: decoding with byte-order marks, line-ending
normalisation, header/footer wrapping, path selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestfold.functions.text import decode_bom, filter_paths, normalise_newlines, normalise_text, read_side_text, wrap_text
from nestfold.operators.numbering import paged
from nestfold.plans.registry import register
from nestfold.session import landed, scratch_path
from nestfold.sinks.tree import write_tree
from nestfold.sources.files import list_files, read_whole_files, relative_path
from nestfold.sources.tables import table

HEADER = "/* Copyright header */\n"
FOOTER = "/* end of file */\n"


def encoded_documents(spark, sf_dir):
    """``documents`` as stored bytes in the encodings a text tree mixes:
    French with CRLF endings and a UTF-8 byte-order mark, German as UTF-16LE
    with a mark, Spanish as UTF-16BE with a mark and CRLF, the rest plain
    UTF-8."""
    docs = table(spark, sf_dir, "documents")
    crlf = F.regexp_replace("text", "\n", "\r\n")
    content = (
        F.when(F.col("lang") == "fr", F.concat(F.unhex(F.lit("EFBBBF")), F.encode(crlf, "UTF-8")))
        .when(F.col("lang") == "de", F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE")))
        .when(F.col("lang") == "es", F.concat(F.unhex(F.lit("FEFF")), F.encode(crlf, "UTF-16BE")))
        .otherwise(F.encode("text", "UTF-8"))
    )
    return docs.select("doc_id", content.alias("content"))


_NORMALISED = """
CASE WHEN regexp_replace(text, chr(13) || chr(10), chr(10), 'g') = ''
       OR suffix(regexp_replace(text, chr(13) || chr(10), chr(10), 'g'), chr(10))
     THEN regexp_replace(text, chr(13) || chr(10), chr(10), 'g')
     ELSE regexp_replace(text, chr(13) || chr(10), chr(10), 'g') || chr(10) END
"""


@register("q_text_normalise", f"SELECT doc_id, {_NORMALISED} AS text FROM documents")
def q_text_normalise(spark, sf_dir):
    """Bytes decoded by their byte-order mark, line endings normalised to
    ``\\n`` with a final newline — whole texts."""
    return normalise_text(encoded_documents(spark, sf_dir)).select("doc_id", "text")


@register(
    "q_text_wrap",
    "SELECT doc_id, '/* Copyright header */' || chr(10) || text || '/* end of file */' || chr(10) AS text FROM documents",
)
def q_text_wrap(spark, sf_dir):
    """Each text between a header and a footer."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", wrap_text(F.col("text"), HEADER, FOOTER).alias("text"))


@register(
    "q_path_filter",
    "SELECT page_id, url FROM pages WHERE contains(lower(url), '/fr/') AND NOT contains(lower(url), 'page=')",
)
def q_path_filter(spark, sf_dir):
    """Rows whose lower-cased path contains one string and none of others."""
    pages = table(spark, sf_dir, "pages")
    selected, _ = filter_paths(pages.select("page_id", "url"), "url", include="/FR/", exclude=["PAGE="])
    return selected


@register(
    "q_text_rewrite",
    f"""
SELECT page_id, url, '/* Copyright header */' || chr(10) || {_NORMALISED.replace('text', 'html')} || '/* end of file */' || chr(10) AS text, true AS rewritten
FROM pages WHERE contains(lower(url), '/fr/') AND NOT contains(lower(url), 'page=')
UNION ALL
SELECT page_id, url, html, false FROM pages WHERE NOT (contains(lower(url), '/fr/') AND NOT contains(lower(url), 'page='))
""",
)
def q_text_rewrite(spark, sf_dir):
    """Tree rewrite: select paths, decode and normalise the selected files,
    wrap them with header and footer and write them; copy the other files
    unchanged; return both halves read back."""
    pages = table(spark, sf_dir, "pages")
    files = pages.select("page_id", "url", F.encode("html", "UTF-8").alias("content"))
    selected, others = filter_paths(files, "url", include="/fr/", exclude=["page="])
    text = wrap_text(normalise_newlines(decode_bom(F.col("content"))), HEADER, FOOTER)
    out = scratch_path(spark, "rewritten")
    selected.select("page_id", "url", text.alias("text")).write.parquet(f"{out}/rewritten")
    # the files not selected are copied unchanged (bytes as read)
    others.select("page_id", "url", "content").write.parquet(f"{out}/copied")
    done = spark.read.parquet(f"{out}/rewritten").withColumn("rewritten", F.lit(True))
    copied = spark.read.parquet(f"{out}/copied").select("page_id", "url", F.decode("content", "UTF-8").alias("text"), F.lit(False).alias("rewritten"))
    return done.unionByName(copied)


@register(
    "q_tree_walk",
    """
SELECT regexp_extract(url, '://([^/]+)', 1) AS host, CAST(sum(strlen(html) + 1) AS BIGINT) AS n_bytes
FROM pages GROUP BY 1
""",
)
def q_tree_walk(spark, sf_dir):
    """Recursive walk of a file tree (one folder per host): every file found,
    its size summed per folder; file contents are not read."""
    pages = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "://([^/]+)", 1).alias("host"), "html"
    )
    root = landed(spark, "page-tree", (sf_dir,), lambda p: pages.write.partitionBy("host").text(p))
    files = list_files(spark, root)
    host = F.regexp_extract("path", "/host=([^/]+)/[^/]*$", 1)
    return files.groupBy(host.alias("host")).agg(F.sum("length").alias("n_bytes"))


# The pages as a tree of files, in SQL: path, content, and its bytes. Every
# fourth page has each of four encodings; a path holds a space at times.
_TREE = r"""
t AS (
  SELECT coalesce(nullif(regexp_extract(url, '://([^/]+)', 1), ''), 'none')
         || CASE WHEN page_id % 7 = 0 THEN '/Initialization Data/' ELSE '/' END || CAST(page_id AS VARCHAR)
         || CASE WHEN contains(lower(url), '/fr/') THEN '.SQL' ELSE '.html' END AS path,
         coalesce(html, '') AS text, page_id % 4 AS kind
  FROM pages),
f AS (
  SELECT *, CAST(CASE WHEN kind < 2 THEN strlen(text) + 3 * kind
                 ELSE 2 + 2 * length(text) + 2 * length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) END AS BIGINT) AS n_bytes
  FROM t)
"""


def land_tree(spark, sf_dir):
    """The pages as files below one root: a folder per host, in four encodings."""

    def write(root):
        pages = table(spark, sf_dir, "pages")
        host = F.coalesce(F.nullif(F.regexp_extract("url", "://([^/]+)", 1), F.lit("")), F.lit("none"))
        folder = F.when(F.col("page_id") % 7 == 0, "/Initialization Data/").otherwise("/")
        ending = F.when(F.lower("url").contains("/fr/"), ".SQL").otherwise(".html")
        text, kind = F.coalesce("html", F.lit("")), F.col("page_id") % 4
        content = F.when(kind == 0, F.encode(text, "UTF-8"))
        for k, (bom, charset) in enumerate((("EFBBBF", "UTF-8"), ("FFFE", "UTF-16LE"), ("FEFF", "UTF-16BE")), 1):
            content = content.when(kind == k, F.concat(F.unhex(F.lit(bom)), F.encode(text, charset)))
        write_tree(pages, root, F.concat(host, folder, F.col("page_id").cast("string"), ending), content)

    return landed(spark, "file-tree", (sf_dir,), write)


PAGE_SIZE = 100


@register(
    "q_file_pages",
    f"""WITH {_TREE}
SELECT path, n_bytes, row_number() OVER (ORDER BY path) AS row_number,
       (row_number() OVER (ORDER BY path) - 1) // {PAGE_SIZE} + 1 AS page, (SELECT count(*) FROM f) AS n_total
FROM f""",
)
def q_file_pages(spark, sf_dir):
    """Every file of a tree with its name and size, its number and page by name,
    and how many files there are; only file metadata is read."""
    root = land_tree(spark, sf_dir)
    files = list_files(spark, root).select(relative_path(F.col("path"), root).alias("path"), F.col("length").alias("n_bytes"))
    return paged(files, ["path"], PAGE_SIZE)


@register(
    "q_text_pipeline",
    f"""WITH {_TREE},
s AS (SELECT path, text, contains(lower(path), '.sql') AND NOT contains(lower(path), 'initialization data') AS rewritten, n_bytes FROM f)
SELECT path, CASE WHEN rewritten THEN '/* Copyright header */' || chr(10) || {_NORMALISED} || '/* end of file */' || chr(10) ELSE text END AS text,
       rewritten, CASE WHEN NOT rewritten THEN n_bytes END AS n_bytes
FROM s""",
)
def q_text_pipeline(spark, sf_dir):
    """A tree of files from files to files: select by path, decode by byte-order
    mark, normalise, put between the texts of a header and a footer file, write
    under the same paths of a new root; copy all other files byte by byte. The
    new tree read back."""
    root, side, out = land_tree(spark, sf_dir), scratch_path(spark, "side"), scratch_path(spark, "tree")
    texts = spark.createDataFrame([("header.txt", HEADER), ("footer.txt", FOOTER)], "path string, content string")
    write_tree(texts, side)
    header, footer = (read_side_text(spark, f"{side}/{n}.txt") for n in ("header", "footer"))
    files = read_whole_files(spark, root).withColumn("path", relative_path(F.col("path"), root))
    selected, others = filter_paths(files)
    text = wrap_text(normalise_newlines(decode_bom(F.col("content"))), header, footer)
    done = selected.select("path", F.encode(text, "UTF-8").alias("content"))
    write_tree(done.unionByName(others.select("path", "content")), out)
    back = read_whole_files(spark, out).withColumn("path", relative_path(F.col("path"), out))
    new, copied = filter_paths(back)
    new = new.select("path", F.decode("content", "UTF-8").alias("text"), F.lit(True).alias("rewritten"), F.lit(None).cast("bigint").alias("n_bytes"))
    return new.unionByName(copied.select("path", decode_bom(F.col("content")).alias("text"), F.lit(False).alias("rewritten"), F.col("length").alias("n_bytes")))
