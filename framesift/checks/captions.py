"""T: caption transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.checks.sqltext import one_decimal, uniform
from framesift.functions import captions, cleaning
from framesift.functions.captions import CAMERA_MOTION_WORDS, CAPTION_PREFIXES
from framesift.operators import captions as ops

_NAMED = [f"'{p}'" for p in CAPTION_PREFIXES] + [f"lower('{p}')" for p in CAPTION_PREFIXES] + ["''"]
_PICK_SQL = "CASE CAST(pos % 31 AS INT) " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(_NAMED)) + " END"
_MODEL_CAPTION = f"concat({_PICK_SQL}, ' ', text)"
_OPTIONS = "|".join(p.replace(".", "\\.") for q in CAPTION_PREFIXES for p in (q, q.lower()))
_TRIM = "regexp_replace(regexp_replace({x}, '^[\\s\\p{{Z}}]+', ''), '[\\s\\p{{Z}}]+$', '')"


@query(
    "T1_strip_caption_prefix",
    f"""SELECT pos, CASE WHEN regexp_matches(c, '^(?:{_OPTIONS})') THEN upper(left(r, 1)) || substr(r, 2) ELSE c END AS text
        FROM (SELECT pos, c, {_TRIM.format(x=f"regexp_replace(c, '^(?:{_OPTIONS})', '')")} AS r
              FROM (SELECT pos, CASE WHEN text IS NOT NULL THEN {_MODEL_CAPTION} END AS c FROM media))""",
)
def t1(t):
    rows = t.media.selectExpr("pos", f"{_MODEL_CAPTION} AS text")
    return rows.select("pos", captions.strip_caption_prefix(F.col("text")).alias("text"))


@query("T2_append_text", "SELECT pos, text || ' High quality.' AS text FROM media")
def t2(t):
    return t.media.select("pos", captions.append_text(F.col("text"), " High quality.").alias("text"))


_WORDS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CAMERA_MOTION_WORDS.items())


@query("T3_merge_camera_motion", f"SELECT pos, coalesce(text || ' Camera motion: ' || CASE cmotion {_WORDS} END || '.', text) AS text FROM media")
def t3(t):
    merged = captions.merge_camera_motion(F.col("text"), F.col("cmotion"), on_unmapped="keep")
    return t.media.select("pos", merged.alias("text"))


_PARTS = f"""concat_ws(', ', CASE WHEN {uniform(8, 'pos', "'aes'")} > 0.2 THEN 'aesthetic score: ' || {one_decimal('aes')} END,
    CASE WHEN {uniform(8, 'pos', "'flow'")} > 0.2 THEN 'motion score: ' || {one_decimal('flow')} END)"""


@query("T4_score_to_text", f"SELECT pos, CASE WHEN {_PARTS} = '' THEN text ELSE text || ' [' || {_PARTS} || ']' END AS text FROM media")
def t4(t):
    return ops.add_scores_to_text(t.media, seed=8).select("pos", "text")


@query(
    "T4_one_decimal",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, format('{:.1f}', l_extendedprice / 7) AS a, format('{:.1f}', l_quantity / 20) AS b FROM lineitem",
)
def t4d(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        captions.fixed1(F.col("l_extendedprice") / 7).alias("a"),
        captions.fixed1(F.col("l_quantity") / 20).alias("b"),
    )


@query(
    "T5_append_score_to_prompt",
    f"""SELECT pos, p || CASE WHEN instr(p, 'aesthetic score:') > 0 THEN '' ELSE ' aesthetic score: ' || {one_decimal('aes')} || '.' END
          || CASE WHEN instr(p, 'motion score:') > 0 THEN '' ELSE ' motion score: ' || {one_decimal('flow')} || '.' END
          || CASE WHEN instr(p, 'camera motion:') > 0 THEN '' ELSE ' camera motion: ' || cmotion || '.' END AS prompt
        FROM (SELECT *, CASE CAST(pos % 3 AS INT) WHEN 0 THEN text WHEN 1 THEN text || ' motion score: 3.0.' ELSE text || ' camera motion: none.' END AS p FROM media)""",
)
def t5(t):
    rows = t.media.selectExpr(
        "*",
        "CASE CAST(pos % 3 AS INT) WHEN 0 THEN text WHEN 1 THEN text || ' motion score: 3.0.' ELSE text || ' camera motion: none.' END AS p",
    )
    out = captions.append_score_to_prompt(F.col("p"), F.col("aes"), F.col("flow"), F.col("cmotion"))
    return rows.select("pos", out.alias("prompt"))


def _documents(t, expression):
    return t.documents.select("doc_id", expression.alias("text"))


_ASCII = "regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')"


def _ascii():
    # Word boundaries of the two regex engines agree on ASCII only.
    return F.regexp_replace("text", r"[^\x00-\x7F]", "")


def _chain(text: str, steps) -> str:
    for pattern, replacement in steps:
        quoted = pattern.replace("'", "''")
        text = f"regexp_replace({text}, '{quoted}', '{replacement.replace('$1', chr(92) + '1')}', 'g')"
    return text


@query("T6a_unquote_and_lower", f"SELECT doc_id, replace(lower({_TRIM.format(x='text')}), '<person>', 'person') AS text FROM documents")
def t6a(t):
    # Escaping first makes every special character, plus sign and percent take the decoding path.
    return _documents(t, cleaning.unquote_and_lower(F.url_encode("text")))


# None of these texts holds an '@', so the look-ahead that spares mail hosts never bites.
_URLS = [(p.replace("(?!@)", ""), "") for p in cleaning.URL_PATTERNS]


@query("T6b_drop_urls", f"SELECT page_id, {_chain("'see ' || url || ' now'", _URLS)} AS text FROM pages")
def t6b(t):
    pages = t.pages.select("page_id", F.concat(F.lit("see "), "url", F.lit(" now")).alias("text"))
    return pages.select("page_id", cleaning.drop_urls(F.col("text")).alias("text"))


_HTML = """regexp_replace(regexp_replace(html, '(?s)<(script|style|template)[^>]*>.*?</(script|style|template)>', '', 'g'), '(?s)<!--.*?-->|<[!/a-zA-Z][^>]*>', '', 'g')"""
_ENTITIES = [("&nbsp;", "chr(160)"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&quot;", "'\"'"), ("&#39;", "''''"), ("&eacute;", "'é'"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&amp;", "'&'")]


def _entities_sql(text: str) -> str:
    for name, char in _ENTITIES:
        text = f"replace({text}, '{name}', {char})"
    return text


@query("T6c_html_to_text", f"SELECT page_id, {_entities_sql(_HTML)} AS text FROM pages")
def t6c(t):
    return t.pages.select("page_id", cleaning.html_to_text(F.col("html")).alias("text"))


@query("T6d_drop_nicknames", "SELECT doc_id, regexp_replace(text, '@[\\p{L}\\p{N}_]+', '', 'g') AS text FROM documents")
def t6d(t):
    return _documents(t, cleaning.drop_nicknames(F.col("text")))


@query("T6e_drop_cjk", "SELECT doc_id, regexp_replace(text || '映画ab' || text, '[\\x{31c0}-\\x{9fff}]+', '', 'g') AS text FROM documents")
def t6e(t):
    return _documents(t, cleaning.drop_cjk(F.concat("text", F.lit("映画ab"), "text")))


@query(
    "T6f_unify_dashes_and_quotes",
    """SELECT doc_id, translate(regexp_replace(replace(replace(replace(text, ', ', ' —– '), '. ', '» '), '''', '’'),
         '[\\x{002D}\\x{058A}\\x{05BE}\\x{1400}\\x{1806}\\x{2010}-\\x{2015}\\x{2E17}\\x{2E1A}\\x{2E3A}\\x{2E3B}\\x{2E40}\\x{301C}\\x{3030}\\x{30A0}\\x{FE31}\\x{FE32}\\x{FE58}\\x{FE63}\\x{FF0D}]+', '-', 'g'),
         '`´«»“”¨‘’', '\"\"\"\"\"\"\"''''') AS text FROM documents""",
)
def t6f(t):
    text = F.col("text")
    for old, new in ((", ", " —– "), (". ", "» "), ("'", "’")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return _documents(t, cleaning.unify_dashes_and_quotes(text))


_RESIDUE = [*cleaning.ENTITY_RESIDUE, (cleaning.IP_ADDRESS, " "), (cleaning.ARTICLE_TIME, ""), (r"\\n", " ")]


@query("T6g_drop_residue", f"SELECT doc_id, {_chain('text', _RESIDUE)} AS text FROM documents")
def t6g(t):
    return _documents(t, cleaning.drop_residue(F.col("text")))


@query("T6h_drop_numbers_and_files", f"SELECT doc_id, {_chain(_ASCII, cleaning.NUMBERS_AND_FILES)} AS text FROM documents")
def t6h(t):
    return _documents(t, cleaning.drop_numbers_and_files(_ascii()))


@query("T6i_calm_punctuation", f"SELECT doc_id, {_chain('text', cleaning.PUNCTUATION)} AS text FROM documents")
def t6i(t):
    return _documents(t, cleaning.calm_punctuation(F.col("text")))


@query("T6j_split_slug", "SELECT doc_id, CASE WHEN length(text) - length(translate(text, '-_', '')) > 3 THEN translate(text, '-_', '  ') ELSE text END AS text FROM documents")
def t6j(t):
    return _documents(t, cleaning.split_slug(F.col("text")))


@query("T6k_fix_text", f"SELECT doc_id, {_TRIM.format(x='text')} AS text FROM documents")
def t6k(t):
    # Doubly escaped and then repaired, every caption comes back as it was.
    escaped = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;amp;")), F.lit("<"), F.lit("&amp;lt;"))
    return _documents(t, cleaning.fix_text(escaped))


@query("T6l_drop_shop_words", f"SELECT doc_id, {_chain(_ASCII, [(p.replace('[xх×]', 'x'), r) for p, r in cleaning.SHOP_AND_ID_WORDS])} AS text FROM documents")
def t6l(t):
    return _documents(t, cleaning.drop_shop_words(_ascii()))


@query("T6m_tidy_edges", f"SELECT doc_id, {_TRIM.format(x=_chain(_ASCII, cleaning.SPACING_AND_EDGES))} AS text FROM documents")
def t6m(t):
    return _documents(t, cleaning.tidy_edges(_ascii()))


def _clean_once_sql(text: str) -> str:
    """The recipe for plain ASCII captions without markup or percent escapes."""
    text = f"lower(trim(replace({text}, '+', ' '), chr(9) || chr(10) || ' '))"
    text = _chain(text, [*_URLS, (cleaning.NICKNAME, ""), ("-+", "-"), *_RESIDUE, *cleaning.NUMBERS_AND_FILES, *cleaning.PUNCTUATION])
    slug = f"list_transform([{text}], lambda x: CASE WHEN length(x) - length(translate(x, '-_', '')) > 3 THEN translate(x, '-_', '  ') ELSE x END)[1]"
    steps = [(p.replace("[xх×]", "x"), r) for p, r in cleaning.SHOP_AND_ID_WORDS] + cleaning.SPACING_AND_EDGES
    return f"trim({_chain(_TRIM.format(x=slug), steps)})"


_PLAIN = "regexp_replace(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), '[<>%`]', '', 'g')"


@query(
    "T6_clean_caption_ascii",
    f"SELECT doc_id, {_clean_once_sql('text')} AS text FROM (SELECT doc_id, {_clean_once_sql('text')} AS text FROM (SELECT doc_id, {_PLAIN} AS text FROM documents))",
)
def t6_ascii(t):
    plain = F.regexp_replace(_ascii(), "[<>%`]", "")
    return ops.clean_caption(t.documents.select("doc_id", plain.alias("text")))


@query("T6_clean_caption")
def t6(t):
    return ops.clean_caption(t.documents.select("doc_id", "text"))


@query("T7_light_clean", f"SELECT doc_id, {_TRIM.format(x='lower(text)')} AS text FROM documents")
def t7(t):
    return _documents(t, captions.light_clean(F.col("text")))


@query("T8_count_tokens", "SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\\s\\p{Z}]+')) AS INT) AS text_len_ws FROM documents")
def t8(t):
    return ops.count_tokens(t.documents).select("doc_id", "text_len_ws")


@query("T8_count_tokens_hook", "SELECT doc_id, CAST(length(text) - length(replace(text, ' ', '')) + 1 AS INT) AS text_len FROM documents")
def t8h(t):
    return ops.count_tokens(t.documents, tokenizer=lambda s: s.count(" ") + 1).select("doc_id", "text_len")


@query("T9_newline_to_space", f"SELECT doc_id, {_TRIM.format(x=f'replace(text, chr(10), chr(32))')} AS text FROM documents")
def t9(t):
    return _documents(t, captions.newline_to_space(F.col("text")))


_ANSWER = "CASE CAST(pos % 4 AS INT) WHEN 0 THEN concat('tags: [', cmotion, ', ', path, '] and [more]') WHEN 1 THEN concat('[ ', text) WHEN 2 THEN concat('[', text, ']') ELSE text END"
_BODY = "CASE WHEN instr(a, '[') > 0 AND instr(a, ']') > instr(a, '[') THEN substr(a, instr(a, '[') + 1, instr(a, ']') - instr(a, '[') - 1) END"


@query(
    "T10_parse_bracket_tags",
    f"""SELECT pos, CASE WHEN b IS NULL OR instr(b, chr(10)) > 0 OR trim(b) = '' THEN 'NONE_FOUND' ELSE b END AS tags
        FROM (SELECT pos, {_BODY} AS b FROM (SELECT pos, {_ANSWER} AS a FROM media))""",
)
def t10(t):
    return t.media.selectExpr("pos", f"{_ANSWER} AS a").select("pos", captions.parse_bracket_tags(F.col("a")).alias("tags"))


TEMPLATES = [
    ("image", "Describe this image in a few sentences.", "image"),
    ("image-text", "Describe this image. Some information about the image is '{}'.", "image"),
    ("video", "Describe this video in detail.", "video"),
    ("video-text", "Describe this video. Some information about the image is '{}'.", "video"),
]
_TEMPLATE_SQL = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ")" for row in TEMPLATES)


@query(
    "T11_render_prompt",
    f"""SELECT pos, CASE WHEN instr(k.key, 'text') > 0 THEN replace(template, '{{}}', text) ELSE template END AS prompt
        FROM (SELECT *, CASE WHEN path LIKE '%.jpg' THEN 'image' ELSE 'video' END || CASE WHEN height > 400 THEN '-text' ELSE '' END AS key FROM media) m
        JOIN (VALUES {_TEMPLATE_SQL}) AS k(key, template, type) ON k.key = m.key""",
)
def t11(t):
    from framesift.functions.paths import media_type

    templates = t.spark.createDataFrame(TEMPLATES, "key string, template string, type string")
    kind = media_type(F.col("path"))
    key = F.concat(kind, F.when(F.col("height") > 400, F.lit("-text")).otherwise(F.lit("")))
    return ops.with_prompts(t.media, templates, key, kind).select("pos", "prompt")


@query(
    "T12_tidy_model_answer",
    f"""SELECT conv_id, turn, role, replace({_TRIM.format(x='text')}, chr(10), ' ') AS text FROM conversations""",
)
def t12(t):
    answer = F.concat(F.lit("USER: hi ASSISTANT: old ASSISTANT:"), "text", F.lit("</s>"))
    return t.conversations.select(
        "conv_id", "turn", "role", captions.tidy_model_answer(answer, "ASSISTANT:", "</s>").alias("text")
    )
