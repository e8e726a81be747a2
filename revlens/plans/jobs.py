"""Jobs over build logs and issue histories."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens import rules
from revlens.session import broadcast_if_small, materialize
from revlens.sources.readers import BLANKS

CHUNK_LINES = 65_536


def _trimmed(line) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def is_block_start(line) -> Column:
    return F.upper(_trimmed(line)).startswith(rules.BLOCK_MARK)


def numbered_blocks(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Give every line its position in the file (``seq``) and its block number.

    A file is cut into chunks of consecutive lines.  Lines and block starts are
    counted per chunk, the small chunk table is summed up along each file, and
    positions are then counted within chunks only: the longest file costs no
    task more than one chunk at a time.  ``last_block`` is the file's last block.
    """
    marked = lines.select(
        "file",
        "line_no",
        "line",
        is_block_start(F.col("line")).cast("int").alias("starts"),
        F.floor(F.col("line_no") / chunk_lines).alias("chunk"),
    )
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        marked.groupBy("file", "chunk")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("starts").alias("n_starts"))
        .select(
            "file",
            "chunk",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_above"),
            F.coalesce(F.sum("n_starts").over(before), F.lit(0)).alias("starts_above"),
            F.sum("n_starts").over(Window.partitionBy("file")).alias("last_block"),
        )
    )
    upto = Window.partitionBy("file", "chunk").orderBy("line_no")
    here = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.join(chunks, ["file", "chunk"]).select(
        "file",
        "line_no",
        "line",
        (F.col("lines_above") + F.row_number().over(upto)).alias("seq"),
        (F.col("starts_above") + F.sum("starts").over(here)).alias("block"),
        "last_block",
    )


def build_blocks(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """One row per block: its header, its last two lines and its outcome.

    ``lines`` holds non-blank lines.  The positions in a block are consecutive,
    so its last two lines are the last even and the last odd one, and the block
    is a plain aggregate whatever its size.
    """
    at = F.struct("seq", "line")
    even = F.col("seq") % 2 == 0
    blocks = numbered_blocks(lines, chunk_lines).groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min(at).alias("head"),
        F.max(F.when(even, at)).alias("last_even"),
        F.max(F.when(~even, at)).alias("last_odd"),
        F.max("last_block").alias("last_block"),
    )
    return _outcomes(_ended(blocks))


def _ended(blocks: DataFrame) -> DataFrame:
    """Header, last line and the line before it, from the first, the last even and the last odd line."""
    return blocks.select(
        "file",
        "block",
        "n_lines",
        F.col("head.line").alias("header"),
        F.greatest("last_even", "last_odd")["line"].alias("last"),
        F.when(F.col("n_lines") > 1, F.least("last_even", "last_odd")["line"]).alias("last_but_one"),
        "last_block",
    )


def _outcomes(blocks: DataFrame) -> DataFrame:
    header, last = F.col("header"), F.col("last")
    status = (
        F.when(F.col("n_lines") < 2, "rejected")
        .when(_trimmed(last).startswith(rules.BUILD_OK), "ok")
        .otherwise("error")
    )
    error = F.when(F.upper(_trimmed(last)) == rules.BUILD_STOP, F.col("last_but_one")).otherwise(last)
    project = F.substr(
        header,
        F.lit(rules.BLOCK_HEAD_LENGTH + 1),
        F.greatest(F.length(header) - rules.BLOCK_HEAD_LENGTH - rules.BLOCK_TAIL_LENGTH, F.lit(0)),
    )
    return blocks.select(
        "file",
        "block",
        "n_lines",
        "header",
        status.alias("status"),
        F.when(status == "error", error).alias("error_line"),
        project.alias("project"),
        (F.col("block") == F.col("last_block")).alias("is_last"),
    )


_PIECE = "file string, start long, piece long, first_no long, n_lines long, header string, last_but_one string, last string"


def block_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The part of each block that lies in one split of a text file, read in one pass that moves no line.

    ``piece`` counts the block starts of the split, so piece 0 goes on with the
    block of the splits above.  ``first_no`` is the position of the piece's first
    line in the split; blank lines do not count.
    """
    mark, blanks = rules.BLOCK_MARK, BLANKS
    columns = [part.split(" ")[0] for part in _PIECE.split(", ")]

    def run(batches):
        # the piece that may go on in the next batch
        now = None
        for batch in batches:
            text = pc.utf8_trim(batch.column(2), characters=blanks)
            full = pc.not_equal(text, "")
            file, start, line, text = (c.filter(full) for c in (*batch.columns, text))
            n = len(line)
            if not n:
                continue
            begins = pc.starts_with(text, pattern=mark).to_numpy(zero_copy_only=False)
            of = start.to_numpy()
            moved = np.ones(n, bool)
            moved[1:] = (of[1:] != of[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            moved[0] = now is None or (now["file"], now["start"]) != (file[0].as_py(), int(of[0]))
            cut = np.flatnonzero(moved | begins)
            if not len(cut) or cut[0]:
                end = int(cut[0]) if len(cut) else n
                now["last_but_one"] = line[end - 2].as_py() if end > 1 else now["last"]
                now["last"] = line[end - 1].as_py()
                now["n_lines"] += end
            ends = np.append(cut[1:], n)
            taken = [c.take(pa.array(at)).to_pylist() for c, at in ((file, cut), (line, cut), (line, np.maximum(ends - 2, 0)), (line, ends - 1))]
            out = []
            for a, b, name, head, second, last in zip(cut.tolist(), ends.tolist(), *taken):
                if now is not None:
                    out.append(now)
                fresh = moved[a]
                now = {
                    "file": name,
                    "start": int(of[a]),
                    "piece": (0 if fresh else now["piece"]) + int(begins[a]),
                    "first_no": 0 if fresh else now["first_no"] + now["n_lines"],
                    "n_lines": b - a,
                    "header": head,
                    "last_but_one": second if b - a > 1 else None,
                    "last": last,
                }
            if out:
                yield pa.RecordBatch.from_pydict({c: [row[c] for row in out] for c in columns}, kinds)
        if now is not None:
            yield pa.RecordBatch.from_pydict({c: [now[c]] for c in columns}, kinds)

    kinds = pa.schema([(p.split(" ")[0], pa.int64() if p.endswith("long") else pa.string()) for p in _PIECE.split(", ")])
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").cast("long").alias("start"),
        F.col("value").alias("line"),
    )
    return lines.mapInArrow(run, _PIECE)


def build_blocks_of_files(spark: SparkSession, path: str) -> DataFrame:
    """What ``build_blocks`` gives for the lines of text files, without numbering or moving them.

    Each split is summed up as its pieces of blocks.  Lines and block starts per
    split place the pieces in their file; blocks that lie in one split are ready, only
    those that touch a border of one are grouped.  Files may be split
    differently from job to job, so the pieces are written first.
    """
    pieces = materialize(block_pieces(spark, path), "block-pieces")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        pieces.groupBy("file", "start")
        .agg(F.sum("n_lines").alias("n"), F.max("piece").alias("n_starts"))
        .select(
            "file",
            "start",
            F.col("n_starts").alias("last_piece"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_above"),
            F.coalesce(F.sum("n_starts").over(before), F.lit(0)).alias("starts_above"),
            F.sum("n_starts").over(Window.partitionBy("file")).alias("last_block"),
        )
    )
    placed = (
        pieces.join(broadcast_if_small(materialize(splits, "block-splits")), ["file", "start"])
        .withColumn("block", F.col("starts_above") + F.col("piece"))
        .withColumn("seq", F.col("lines_above") + F.col("first_no") + F.col("n_lines"))
    )
    inside = (F.col("piece") > 0) & (F.col("piece") < F.col("last_piece"))
    last = F.struct("seq", F.col("last").alias("line"))
    second = F.when(F.col("n_lines") > 1, F.struct((F.col("seq") - 1).alias("seq"), F.col("last_but_one").alias("line")))
    even = F.col("seq") % 2 == 0
    border = placed.filter(~inside).groupBy("file", "block").agg(
        F.sum("n_lines").alias("n_lines"),
        F.min(F.struct("seq", F.col("header").alias("line"))).alias("head"),
        F.max(F.when(even, last).otherwise(second)).alias("last_even"),
        F.max(F.when(even, second).otherwise(last)).alias("last_odd"),
        F.max("last_block").alias("last_block"),
    )
    whole = placed.filter(inside).select("file", "block", "n_lines", "header", "last", "last_but_one", "last_block")
    return _outcomes(whole.unionByName(_ended(border)))


def build_errors(lines: DataFrame, legacy=False, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Projects by the error their build ended with, both sorted.

    One row per failed block rather than one list per error, since one error may
    stop most builds.  ``legacy`` leaves out each file's last block.
    """
    return _failed(build_blocks(lines, chunk_lines), legacy)


def build_errors_of_files(spark: SparkSession, path: str, legacy=False) -> DataFrame:
    """``build_errors`` for text files; of their lines only those at the ends of blocks leave the tasks that read them."""
    return _failed(build_blocks_of_files(spark, path), legacy)


def _failed(blocks: DataFrame, legacy: bool) -> DataFrame:
    failed = blocks.filter(F.col("status") == "error")
    if legacy:
        failed = failed.filter(~F.col("is_last"))
    return failed.select("error_line", "project", "file", "block").orderBy("error_line", "project", "file", "block")


def status_of_message(message: Column, fixed=False) -> Column:
    """Issue status a history message stands for.

    After ``Status Changed to`` the first space-separated token counts, which is
    empty when a space follows directly; ``fixed`` skips that space.
    """
    chain = F
    for start, status in rules.STATUS_BY_START:
        chain = chain.when(message.startswith(start), F.lit(status))
    for part, status in rules.STATUS_BY_CONTENT:
        chain = chain.when(message.contains(part), F.lit(status))
    rest = F.substr(message, F.lit(len(rules.STATUS_CHANGE_START) + 1))
    rest = F.regexp_replace(rest, "^ ", "") if fixed else rest
    return chain.when(
        message.startswith(rules.STATUS_CHANGE_START), F.split_part(rest, F.lit(" "), F.lit(1))
    ).otherwise(F.lit(rules.STATUS_UNKNOWN))


def history_lines(docs: DataFrame) -> DataFrame:
    """Every line of every history, without its date."""
    history = F.rtrim("history", F.lit("\n"))
    lines = docs.filter(history != "").select(F.explode(F.split(history, "\n")).alias("line"))
    size = rules.HISTORY_DATE_LENGTH
    return lines.select(
        F.when(F.length("line") < size, F.col("line")).otherwise(F.substr("line", F.lit(size + 1))).alias("message")
    )


def history_messages(docs: DataFrame, max_docs: int | None = None, fixed=False) -> DataFrame:
    """Distinct history messages of unknown status, sorted.

    ``max_docs`` keeps the documents with the lowest ids.
    """
    if max_docs is not None:
        docs = docs.orderBy("doc_id").limit(max_docs)
    unknown = F.upper(status_of_message(F.col("message"), fixed)) == rules.STATUS_UNKNOWN
    return history_lines(docs).distinct().filter(unknown).orderBy("message")


def feature_reference(feature: Column) -> Column:
    """``#1234 - AB`` from a title that starts with it, empty for an empty title."""
    words = F.split(feature, " ")
    return F.when(F.coalesce(feature, F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.get(words, F.lit(0)), F.lit(" - "), F.get(words, F.lit(2)))
    )


def bug_to_feature(docs: DataFrame, newest: int | None = None) -> DataFrame:
    """Documents that have a reference, with the feature they belong to; only the ``newest`` if given."""
    named = docs.filter(F.coalesce("reference", F.lit("")) != "")
    if newest is not None:
        named = named.orderBy(F.desc("doc_id")).limit(newest)
    return (
        named.select("doc_id", "reference", feature_reference(F.col("feature")).alias("feature_reference"), "feature")
    )
