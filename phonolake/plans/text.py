"""Queries over texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.functions.sql import register
from phonolake.operators import corpus
from phonolake.operators import text as ops
from phonolake.operators.vocab import vocab_encode
from phonolake.plans import inputs as I
from phonolake.plans.corpus import WS_SQL
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sentences_sql(text: str, granularity: str) -> str:
    pattern = sql_text(X.piece_pattern(granularity))
    return (
        f"list_filter(list_transform(regexp_extract_all({text}, {pattern}), lambda p: trim(p, {WS_SQL})), "
        "lambda p: p <> '')"
    )


def _split(name: str, granularity: str):
    @query(
        name,
        f"""SELECT doc_id, (generate_subscripts(s, 1) - 1)::INTEGER AS sentence_index, unnest(s) AS sentence_text
            FROM (SELECT doc_id, {sentences_sql("text", granularity)} AS s FROM documents)""",
    )
    def run(spark, sf_dir):
        docs = I.table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
        return ops.split_sentences(docs, "text", granularity)


_split("split_sentences", "sentence")
_split("split_clauses", "clause")

_MAP_SQL = "MAP {" + ", ".join(f"{sql_text(k)}: {sql_text(v)}" for k, v in T.PHONEMES.items()) + "}"
_SYMBOLS_SQL = sql_text("|".join(sorted(T.PHONEMES, key=len, reverse=True)))
PHONEME_SQL = {
    "phonemes": f"""
        SELECT doc_id, list_transform(regexp_extract_all(regexp_replace(trim(text, {WS_SQL}), ' +', ' ', 'g'),
          {_SYMBOLS_SQL}), lambda s: ({_MAP_SQL})[s]) AS p FROM documents"""
}


@query(
    "ipa_to_tokens",
    with_inputs(
        """SELECT doc_id, md5(array_to_string(p, '')) AS tokens_md5, len(p)::INTEGER AS n FROM phonemes""", **PHONEME_SQL
    ),
)
def ipa_to_tokens(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents", spread=True)
    rows = ops.phonemes(docs.select("doc_id", F.col("text").alias("ipa")))
    return rows.select(
        "doc_id",
        F.md5("phoneme_text").alias("tokens_md5"),
        F.regexp_count("phoneme_text", F.lit(r"<\|ph_")).alias("n"),
    )


@query(
    "phoneme_ids",
    with_inputs(
        f"""SELECT doc_id, md5(array_to_string(list_transform(p, lambda t: list_position(v, t) + 9), ',')) AS ids_md5
            FROM phonemes, (SELECT list_sort(map_values({_MAP_SQL})) AS v)""",
        **PHONEME_SQL,
    ),
)
def phoneme_ids(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents", spread=True)
    rows = ops.phoneme_ids(docs.select("doc_id", F.col("text").alias("ipa")), first_id=10)
    return rows.select("doc_id", C.digest(F.col("phoneme_ids")).alias("ids_md5"))


@query(
    "distinct_phonemes",
    with_inputs("SELECT token FROM (SELECT DISTINCT unnest(p) AS token FROM phonemes)", **PHONEME_SQL),
)
def distinct_phonemes(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents", spread=True)
    found = F.array_distinct(X.ipa_lookup(F.col("text"), T.PHONEMES))
    return corpus.distinct_sorted(docs.select(F.explode(found).alias("token")), "token")


@query(
    "parse_token",
    with_inputs(
        """SELECT request_id, seq, try_cast(nullif(regexp_extract(text, '<custom_token_([0-9+-]+)>$', 1), '') AS BIGINT)
             AS token_number FROM token_events"""
    ),
)
def parse_token(spark, sf_dir):
    rows = I.token_events(spark, sf_dir)
    return rows.select("request_id", "seq", X.last_token_number(F.col("text")).alias("token_number"))


@query(
    "count_tokens",
    with_inputs(
        """SELECT request_id, sum(len(regexp_extract_all(text, '<custom_token_[0-9]+>')))::BIGINT AS n
           FROM token_events GROUP BY 1"""
    ),
)
def count_tokens(spark, sf_dir):
    rows = I.token_events(spark, sf_dir).withColumn("n", X.count_tokens(F.col("text")))
    return rows.groupBy("request_id").agg(F.sum("n").alias("n"))


# Prompts with tags: each conversation turn gets the tag and the style word that its ids choose.
_TAGS = ", ".join(sql_text(t) for t in T.EMOTIVE_TAGS)
_STYLE = ", ".join(sql_text(w) for w in T.STYLE_WORDS)
TAGGED_PROMPT_SQL = {
    "tagged_prompts": f"""
        SELECT conv_id * 100 + turn AS prompt_id, text || ' <' || [{_TAGS}][turn % 8 + 1] || '> said in a ' ||
          [{_STYLE}][conv_id % 20 + 1] || ' voice <' || [{_TAGS}][conv_id % 8 + 1] || '>' AS text FROM conversations"""
}


def tagged_prompts(spark, sf_dir):
    def pick(items, index):
        return F.get(F.array(*map(F.lit, items)), (index % len(items)).cast("int"))

    conv, turn = F.col("conv_id"), F.col("turn")
    return I.table(spark, sf_dir, "conversations").select(
        (conv * 100 + turn).alias("prompt_id"),
        F.concat(
            "text",
            F.lit(" <"),
            pick(T.EMOTIVE_TAGS, turn),
            F.lit("> said in a "),
            pick(T.STYLE_WORDS, conv),
            F.lit(" voice <"),
            pick(T.EMOTIVE_TAGS, conv),
            F.lit(">"),
        ).alias("text"),
    )


@query(
    "emotive_tags",
    with_inputs(
        f"""SELECT prompt_id, kind, word, count(*) AS n FROM
              (SELECT prompt_id, 'tag' AS kind,
                 unnest(regexp_extract_all(lower(text), '<({"|".join(T.EMOTIVE_TAGS)})>', 1)) AS word FROM tagged_prompts
               UNION ALL
               SELECT prompt_id, 'style', unnest(list_filter(regexp_extract_all(lower(text), '[a-zà-ÿ]+'),
                 lambda w: list_contains([{_STYLE}], w))) FROM tagged_prompts)
            GROUP BY ALL""",
        **TAGGED_PROMPT_SQL,
    ),
)
def emotive_tags(spark, sf_dir):
    return ops.emotive_tags(tagged_prompts(spark, sf_dir), "prompt_id")


@query(
    "request_plan",
    """SELECT o AS "offset", run_id, label || '_run' || run_id AS label, 'Chapter ' || run_id || ': ' || p AS prompt,
         run_id < 3 AS saved
       FROM (SELECT doc_id // 50 * 50 AS o, doc_id AS run_id, label, p FROM
               (SELECT doc_id, unnest(['short', 'medium', 'long']) AS label,
                  unnest(['Read document ' || source, 'Read it in ' || lang, text]) AS p FROM documents)
             UNION ALL
             SELECT DISTINCT doc_id // 50 * 50, 90 + doc_id // 50 * 50, 'warmup', 'warmup' FROM documents)""",
)
def request_plan(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    runs = docs.select(
        (F.col("doc_id") - F.col("doc_id") % 50).alias("offset"), F.col("doc_id").alias("run_id"), "source", "lang", "text"
    )
    prompts = [F.concat(F.lit("Read document "), "source"), F.concat(F.lit("Read it in "), "lang"), F.col("text")]
    return ops.request_plan(runs, prompts)


ENCODE_SQL = with_inputs(
        """SELECT doc_id, md5(string_agg(coalesce(id, -1), ',' ORDER BY pos)) AS ids_md5, count(*) AS n
           FROM (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM
             (SELECT doc_id, regexp_extract_all(text, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]') AS w FROM documents))
           LEFT JOIN vocab USING (token) GROUP BY doc_id"""
)


def _encoded(spark, sf_dir, **limit):
    docs = I.table(spark, sf_dir, "documents", spread=True)
    rows = docs.select("doc_id", X.text_tokens(F.col("text")).alias("words")).where(F.size("words") > 0)
    ids = vocab_encode(rows, I.vocab(spark, sf_dir), "doc_id", "words", **limit)
    return ids.select("doc_id", C.digest(F.col("ids")).alias("ids_md5"), F.size("ids").cast("long").alias("n"))



@query("vocab_encode", ENCODE_SQL)
def vocab_encode_documents(spark, sf_dir):
    return _encoded(spark, sf_dir)


@query("vocab_encode_by_join", ENCODE_SQL)
def vocab_encode_by_join(spark, sf_dir):
    """The way of a vocabulary that is too large to hand out."""
    return _encoded(spark, sf_dir, most=0)


@query(
    "sql_functions",
    f"""SELECT doc_id, len({sentences_sql("text", "sentence")})::INTEGER AS n_sentences,
          len({sentences_sql("text", "clause")})::INTEGER AS n_clauses,
          md5(source || ': ' || text) AS prompt_md5 FROM documents""",
)
def sql_functions(spark, sf_dir):
    register(spark)
    I.table(spark, sf_dir, "documents", spread=True).createOrReplaceTempView("phonolake_documents")
    return spark.sql(
        """SELECT doc_id, size(text_sentences(text)) AS n_sentences, size(text_clauses(text)) AS n_clauses,
             md5(voice_prompt(source, text)) AS prompt_md5 FROM phonolake_documents"""
    )
