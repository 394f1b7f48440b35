"""Token counts of texts of any length."""

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glimmer.llm._common import documents, table
from glimmer.llm._tokenize import WHITE_SPACE, encoder, slices

_STABLE = re.compile(f"(?<=[{WHITE_SPACE}])(?=[^{WHITE_SPACE}])")
_CHUNKS = "_row long, doc_id long, n_bytes long, lead int, core int, last boolean, text string"


def count_tokens(
    df: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    chunk_chars: int = 16_384,
    overlap_chars: int = 256,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, n_chunks`` of each row of ``df``.

    Texts up to ``chunk_chars`` characters are encoded where they lie. A longer text is cut into chunks that
    overlap by ``overlap_chars``, dealt out to all executors and encoded with offsets. Two neighbours are spliced
    at the first stable boundary of their overlap: the change from white space to a word, which the tokenizer never
    joins over, where both encodings start a token. An overlap without one is doubled until it has one or the text
    ends. Tokenizers whose pieces may span white space get no chunks: their texts are encoded whole.

    Null text counts as empty (0 bytes, 0 tokens, one chunk). A null id stays null. Repeated rows each get their
    row. An empty table gives an empty result. Other columns of ``df`` are ignored, whatever their names.
    """
    docs = documents(df, id_col, text_col).withColumn("_row", F.monotonically_increasing_id())
    long = F.length("text") > chunk_chars if _chunks_allowed(tokenizer) else F.lit(False)
    own = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))

    def count(batches):
        enc = encoder(tokenizer)
        for part, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array([len(b) // 4 for b in enc.ids(texts)], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    short = own.filter(~long).select("doc_id", "n_bytes", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")

    def cut(batches):
        for part, texts in slices(batches):
            of = [(i, *c) for i, t in enumerate(texts) for c in chunks(t, chunk_chars, overlap_chars)]
            at, lead, core, last, text = zip(*of, strict=True)
            whose = [part.column(c).take(pa.array(at)) for c in ("_row", "doc_id", "n_bytes")]
            own = [pa.array(lead, pa.int32()), pa.array(core, pa.int32()), pa.array(last, pa.bool_()), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(whose + own, ["_row", "doc_id", "n_bytes", "lead", "core", "last", "text"])

    def splice(batches):
        enc = encoder(tokenizer)
        for part, texts in slices(batches):
            lead, core, last = (part.column(c).to_pylist() for c in ("lead", "core", "last"))
            n = [between(enc.tokenizer, *x) for x in zip(texts, lead, core, last, strict=True)]
            whose = [part.column(c) for c in ("_row", "doc_id", "n_bytes")]
            yield pa.RecordBatch.from_arrays([*whose, pa.array(n, pa.int64())], ["_row", "doc_id", "n_bytes", "n_tokens"])

    huge = (
        own.filter(long).mapInArrow(cut, _CHUNKS)
        .repartition(F.col("_row"), F.xxhash64("text"))
        .mapInArrow(splice, "_row long, doc_id long, n_bytes long, n_tokens long")
        .groupBy("_row", "doc_id", "n_bytes").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_chunks"))
    )
    both = short.withColumn("n_chunks", F.lit(1).cast("long")).unionByName(huge.drop("_row"))
    return both.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks")


def _chunks_allowed(tokenizer: str) -> bool:
    return encoder(tokenizer).form == "dropped"


def chunks(text: str, size: int, overlap: int):
    """(lead, core, last, chunk) of the chunks of ``text``: a chunk's own tokens start from ``lead`` up to ``core``;
    what follows is the overlap, which the next chunk starts with."""
    start = lead = 0
    while True:
        end = start + size
        width, cut = overlap, None
        while end < len(text) and cut is None:
            cut = _STABLE.search(text, end, min(end + width, len(text)))
            if cut is None and end + width >= len(text):
                break
            width *= 1 if cut else 2
        if cut is None:  # the text ends here, or has no stable boundary any more
            yield lead, len(text) - start, True, text[start:]
            return
        stop = min(end + width, len(text))
        yield lead, cut.start() - start, False, text[start:stop]
        start = max(end, cut.start() - overlap)
        lead = cut.start() - start


def between(tokenizer, text: str, lead: int, core: int, last: bool) -> int:
    """Tokens of a chunk that start from ``lead`` up to ``core``; both must be where tokens start."""
    starts = [a for a, _ in tokenizer.encode(text, add_special_tokens=False).offsets]
    own = sum(lead <= a < core for a in starts)
    edges = set(starts)
    if lead and lead not in edges or not last and core not in edges:
        raise ValueError("neighbouring chunks do not agree at a stable boundary")
    return own


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op1_token_counts": op1_token_counts}
