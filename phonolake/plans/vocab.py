"""Queries over vocabularies and token vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import text as X
from phonolake.operators import subwords
from phonolake.operators import vocab as ops
from phonolake.plans import inputs as I
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query
from phonolake.sources import readers


@query("build_vocab", with_inputs("SELECT token, id FROM vocab"))
def build_vocab(spark, sf_dir):
    return I.vocab(spark, sf_dir)


@query(
    "vocab_decode",
    "SELECT doc_id, md5(regexp_replace(text, '[\\x09-\\x0D\\x20]', '', 'g')) AS text_md5 FROM documents",
)
def vocab_decode(spark, sf_dir):
    """Encode all tokens and decode them again: the texts must come back, but for their blanks."""
    words = I.vocab(spark, sf_dir)
    docs = I.table(spark, sf_dir, "documents", spread=True).select("doc_id", X.text_tokens(F.col("text")).alias("words"))
    ids = ops.vocab_encode(docs, words, "doc_id", "words")
    back = ops.vocab_decode(ids, words, "doc_id", "ids")
    return back.select("doc_id", F.md5(F.array_join("tokens", "")).alias("text_md5"))


#: A public rank file; any other one can take its place.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Pieces by the same pattern, which looks ahead: a break is put in front of the last blank of several before a word. Merging
# goes pair by pair over the distinct pieces, whose bytes are written as hex digits.
_BLANK = "\\x09-\\x0D\\x20"
SUBWORD_SQL = {
    "ranks": f"""
        SELECT hex(from_base64(split_part(line, ' ', 1))) AS h, split_part(line, ' ', 2)::INTEGER AS id
        FROM read_csv('{RANKS}', columns = {{'line': 'VARCHAR'}}, delim = '\t', header = false, quote = '', escape = '')""",
    "doc_pieces": f"""
        SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM (SELECT doc_id, list_filter(regexp_extract_all(
            regexp_replace(text, '([{_BLANK}])([{_BLANK}][^{_BLANK}])', '\\1' || chr(57344) || '\\2', 'g'),
            '\\x{{E000}}|''s|''t|''re|''ve|''m|''ll|''d| ?\\pL+| ?\\pN+| ?[^{_BLANK}\\pL\\pN\\x{{E000}}]+|[{_BLANK}]+'),
            lambda x: x <> chr(57344)) AS p FROM documents)""",
    "merges": """
        SELECT piece, list_transform(range(0, octet_length(encode(piece))),
          lambda i: substr(hex(encode(piece)), 2 * i + 1, 2)) AS parts FROM (SELECT DISTINCT piece FROM doc_pieces)
        UNION ALL
        SELECT piece, list_concat(list_concat(parts[:b.i - 1], [parts[b.i] || parts[b.i + 1]]), parts[b.i + 2:]) FROM (
          SELECT piece, parts, min({'id': id, 'i': i}) AS b FROM
            (SELECT piece, parts, unnest(range(1, len(parts))) AS i FROM merges) JOIN ranks ON h = parts[i] || parts[i + 1]
          GROUP BY piece, parts)""",
    "piece_ids": """
        SELECT piece, list(id ORDER BY n) AS ids FROM
          (SELECT piece, unnest(p) AS h, generate_subscripts(p, 1) AS n FROM
            (SELECT piece, arg_min(parts, len(parts)) AS p FROM merges GROUP BY piece)) JOIN ranks USING (h)
        GROUP BY piece""",
    "doc_ids": """
        SELECT doc_id, flatten(list(ids ORDER BY k)) AS ids FROM doc_pieces JOIN piece_ids USING (piece) GROUP BY doc_id""",
}


def subword_ids(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents", spread=True)
    return subwords.subword_encode(docs, readers.read_ranks(spark, f"file://{RANKS}"), F.col("text"))


@query(
    "subword_encode",
    with_inputs(
        """SELECT d.doc_id, coalesce(len(ids), 0)::INTEGER AS n_ids, md5(coalesce(array_to_string(ids, ','), '')) AS ids_md5
           FROM documents d LEFT JOIN doc_ids USING (doc_id)""",
        **SUBWORD_SQL,
    ),
)
def subword_encode(spark, sf_dir):
    """Subword ids of every whole document."""
    rows = subword_ids(spark, sf_dir)
    return rows.select("doc_id", F.size("ids").alias("n_ids"), C.digest(F.col("ids")).alias("ids_md5"))


@query("subword_decode", "SELECT doc_id, md5(coalesce(text, '')) AS text_md5 FROM documents")
def subword_decode(spark, sf_dir):
    """Subword ids decoded again: the texts must come back to the byte."""
    ranks = readers.read_ranks(spark, f"file://{RANKS}")
    back = subwords.subword_decode(subword_ids(spark, sf_dir), ranks, "doc_id")
    return back.select("doc_id", F.md5("text").alias("text_md5"))


EXTEND_SQL = {
    "new_tokens": """
        SELECT token, min(conv_id * 100 + turn) AS ord FROM
          (SELECT conv_id, turn, unnest(regexp_extract_all(text, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]')) AS token FROM conversations)
        GROUP BY 1"""
}


@query(
    "extend_vocab",
    with_inputs(
        """SELECT token, id, CASE WHEN token IN (SELECT token FROM new_tokens) THEN 'skipped' ELSE 'base' END AS status
           FROM vocab
           UNION ALL
           SELECT token, ((SELECT max(id) FROM vocab) + row_number() OVER (ORDER BY ord, token))::INTEGER, 'added'
           FROM new_tokens WHERE token NOT IN (SELECT token FROM vocab)""",
        **EXTEND_SQL,
    ),
)
def extend_vocab(spark, sf_dir):
    """The words of all conversations as new tokens, in order of first use."""
    turns = I.table(spark, sf_dir, "conversations")
    new = turns.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("ord"),
        F.explode(F.array_distinct(X.text_tokens(F.col("text")))).alias("token"),
    )
    return ops.extend_vocab(I.vocab(spark, sf_dir), new)


# One token per label with its vectors as members, and one without members for each language.
@query(
    "mean_embedding",
    """SELECT token, md5(array_to_string(list_transform(v, lambda x: (x * 1000000)::BIGINT), ',')) AS vec_md5,
         len(v)::INTEGER AS dims FROM
       (SELECT token, list(x ORDER BY dim) AS v FROM (
          SELECT 'label' || label AS token, dim, round(avg(x::DOUBLE), 6) AS x FROM
            (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)
          GROUP BY 1, 2
          UNION ALL
          SELECT lang, dim, x FROM (SELECT DISTINCT lang FROM documents),
            (SELECT dim, round(avg(x::DOUBLE), 6) AS x FROM
              (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY 1))
        GROUP BY token)""",
)
def mean_embedding(spark, sf_dir):
    table = I.table(spark, sf_dir, "embeddings")
    own = table.select(F.concat(F.lit("label"), F.col("label").cast("string")).alias("token"), F.col("vec_id").alias("id"))
    langs = I.table(spark, sf_dir, "documents").select(F.col("lang").alias("token")).distinct()
    members = own.unionByName(langs.withColumn("id", F.lit(None).cast("long")))
    rows = ops.mean_embedding(members, table.select(F.col("vec_id").alias("id"), "embedding"))
    fixed = F.transform("embedding", lambda x: F.round(F.round(x, 6) * 1_000_000).cast("long"))
    return rows.select("token", F.md5(F.array_join(fixed.cast("array<string>"), ",")).alias("vec_md5"), F.size("embedding").alias("dims"))
