"""DuckDB statements of the same operators, for the oracle check.

These strings restate each operator in plain SQL over the driver tables;
they are independent of the Spark code paths (different formulations where
it matters: the chunker is a recursive CTE stepping one chunk at a time).
"""

from __future__ import annotations

from html import entities

# The statements spell out their own patterns (RE2) and tables, so that a
# wrong pattern on the Spark side does not go unseen.
SPACES = (r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
STRIP = f"^{SPACES}+|{SPACES}+$"
TOKENS = r"[\pL\pN]+|[^\x09-\x0D \pL\pN]"
WORDS = r"[\pL\pN]+"
TAG_END = r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""
HIDDEN = (r"(?is)<script\b" + TAG_END + r".*?(?:</script\s*>|\z)|<style\b" + TAG_END + r".*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)")
ANY_MARKUP = HIDDEN + r"|</?[a-z!?]" + TAG_END
TITLE_ELEMENT = r"(?is)<title\b" + TAG_END + r"(.*?)</title\s*>"
SHORT_NAMES = "|".join(sorted((k for k in entities.html5 if k[-1] != ";"), key=len, reverse=True))
REFERENCES = r"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;|&(?:" + SHORT_NAMES + ")|[^&]+|&"


# Fixed values, spelled out once more for the statements.
MODELS = """gpt-4o
gpt-35-turbo
gpt-35-turbo-16k
HuggingFaceH4/zephyr-7b-beta
mistralai/Mistral-7B-Instruct-v0.2
codellama/CodeLlama-34b-Instruct-hf
meta-llama/Meta-Llama-3-8B-Instruct
microsoft/Phi-3-mini-4k-instruct
mistralai/Mixtral-8x7B-Instruct-v0.1""".split("\n")
MODEL_ERROR = (
    "Model not found in the list of supported models: ['gpt-4o', 'gpt-35-turbo', 'gpt-35-turbo-16k', 'HuggingFaceH4/zephyr-7b-beta', "
    "'mistralai/Mistral-7B-Instruct-v0.2', 'codellama/CodeLlama-34b-Instruct-hf', 'meta-llama/Meta-Llama-3-8B-Instruct', "
    "'microsoft/Phi-3-mini-4k-instruct', 'mistralai/Mixtral-8x7B-Instruct-v0.1'].")
PROVIDERS = ["AzureOpenAI", "HuggingFace"]
PROMPT = """Use the below information chunks to answer the subsequent question. If the answer cannot be found, write 'I don't know.'
....
........DOCUMENTS:
........{context}
........
........Whenever possible cite the source of the information using the metadata provided (i.e., mention for example the title of the document and on which page).
........
........Question: {question}
........""".replace("\n........", "\n" + 8 * " ").replace("\n....", "\n" + 4 * " ")


def prompt(context: str, question: str) -> str:
    """The prompt with two SQL expressions in it."""
    head, rest = PROMPT.split("{context}")
    middle, tail = rest.split("{question}")
    return f"({q(head)} || coalesce({context}, '') || {q(middle)} || {question} || {q(tail)})"


def split_words(x: str) -> str:
    """Number of pieces between white space, as ``str.split()`` cuts."""
    return f"len(list_filter(regexp_split_to_array({x}, {q(SPACES + '+')}), lambda w: w <> ''))"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def as_map(items) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in items) + "}"


def windows_1252() -> str:
    pairs = []
    for n in range(128, 160):
        try:
            pairs.append((str(n), bytes([n]).decode("cp1252")))
        except UnicodeDecodeError:
            pass
    return as_map(pairs)


def code_point(n: str) -> str:
    """Character of a number that may be NULL (too large)."""
    return (f"CASE WHEN {n} IS NULL OR {n} = 0 OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN chr(65533) "
            f"WHEN {n} BETWEEN 128 AND 159 THEN coalesce(map_extract_value({windows_1252()}, CAST({n} AS VARCHAR)), chr({n}::INTEGER)) "
            f"ELSE chr({n}::INTEGER) END")


def decode_refs(x: str) -> str:
    full = as_map((k[:-1], v) for k, v in entities.html5.items() if k[-1] == ";")
    short = as_map((k, v) for k, v in entities.html5.items() if k[-1] != ";")
    hexa = "TRY_CAST('0x' || rtrim(substr(t, 4), ';') AS BIGINT)"
    deci = "TRY_CAST(rtrim(substr(t, 3), ';') AS BIGINT)"
    start = f"regexp_extract(t, {q('^&(' + SHORT_NAMES + ')')}, 1)"
    return (f"CASE WHEN contains({x}, '&') THEN array_to_string(list_transform(regexp_extract_all({x}, {q(REFERENCES)}), lambda t: CASE "
            f"WHEN t[1:3] IN ('&#x', '&#X') THEN {code_point(hexa)} WHEN t[1:2] = '&#' AND length(t) > 2 THEN {code_point(deci)} "
            f"WHEN t[1:1] = '&' AND length(t) > 1 THEN coalesce(map_extract_value({full}, rtrim(substr(t, 2), ';')), "
            f"map_extract_value({short}, {start}) || substr(t, length({start}) + 2), t) ELSE t END), '') ELSE {x} END")


def html_text_sql(x: str) -> str:
    return decode_refs(f"regexp_replace({x}, {q(ANY_MARKUP)}, '', 'g')")


def html_title_sql(x: str) -> str:
    title = f"regexp_extract(regexp_replace({x}, {q(HIDDEN)}, '', 'g'), {q(TITLE_ELEMENT)}, 1)"
    return decode_refs(f"regexp_replace({title}, {q(ANY_MARKUP)}, '', 'g')")


def normalise(x: str) -> str:
    return f"translate({x}, chr(10) || chr(9) || chr(160), '   ')"


def newlines(x: str) -> str:
    return f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP)}, '', 'g')"


def token_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {q(TOKENS)}))"


def stable_id(*parts: str) -> str:
    inner = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"sha256(concat_ws(chr(31), {inner}))"


def hash_codes(x: str, dim: int = 64) -> str:
    return (f"list_transform(list_transform(regexp_extract_all(lower({x}), {q(WORDS)}), lambda w: md5(w)), "
            f"lambda h: (('0x' || substr(h, 1, 8))::BIGINT % {dim}) + "
            f"CASE WHEN ('0x' || substr(h, 9, 1))::INTEGER >= 8 THEN {dim} ELSE 0 END)")


def dense(codes: str, dim: int = 64) -> str:
    return (f"list_transform(range(0, {dim}), lambda i: CAST(len(list_filter({codes}, lambda c: c = i)) "
            f"- len(list_filter({codes}, lambda c: c = i + {dim})) AS DOUBLE))")


def vec_norm(v: str) -> str:
    return f"sqrt(list_reduce(list_transform({v}, lambda x: x * x), lambda a, b: a + b, 0.0::DOUBLE))"


def hashed_ctes(name: str, src: str, text: str, dim: int = 64) -> str:
    """``{name}``: every column of ``src`` plus the unit hash vector ``embedding``."""
    return f"""
{name}_codes AS (SELECT *, {hash_codes(text, dim)} AS _codes FROM {src}),
{name}_dense AS (SELECT *, {dense("_codes", dim)} AS _dense FROM {name}_codes),
{name}_normed AS (SELECT *, {vec_norm("_dense")} AS _norm FROM {name}_dense),
{name} AS (
  SELECT * EXCLUDE (_codes, _dense, _norm),
         CASE WHEN _norm > 0 THEN list_transform(_dense, lambda x: x / _norm) ELSE _dense END AS embedding
  FROM {name}_normed)"""


def dot(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]), "
            f"lambda s, x: s + x, 0.0::DOUBLE)")


def vec_text(v: str) -> str:
    return f"array_to_string(list_transform({v}, lambda x: printf('%.6f', x)), ',')"


# --- sources -----------------------------------------------------------------

TXT_DOCS = r"""
txt_docs AS (
  SELECT doc_id, lang AS subject, printf('corpus/%s/doc-%d.txt', lang, doc_id) AS path, 'txt' AS format,
         CAST(NULL AS INTEGER) AS page, {content} AS page_content,
         'Klexikon' AS meta_source, CAST(NULL AS VARCHAR) AS meta_title,
         printf('corpus/%s/doc-%d.txt', lang, doc_id) AS meta_path, CAST(NULL AS INTEGER) AS meta_page
  FROM documents)""".replace("{content}", newlines("text"))

PAGE_FILES = r"""
page_files AS (
  SELECT page_id, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})(/|$)', 1), ''), 'web') AS subject,
         {body} AS body
  FROM pages)""".replace("{body}", newlines("html"))

HTML_DOCS = r"""
html_docs AS (
  SELECT page_id, subject, printf('corpus/%s/page-%d.html', subject, page_id) AS path, 'html' AS format,
         CAST(NULL AS INTEGER) AS page, {text} AS page_content,
         printf('corpus/%s/page-%d.html', subject, page_id) AS meta_source, {title} AS meta_title,
         CAST(NULL AS VARCHAR) AS meta_path, CAST(NULL AS INTEGER) AS meta_page
  FROM page_files)""".replace("{text}", html_text_sql("body")).replace("{title}", html_title_sql("body"))

CORPUS_DOCS = """
corpus_docs AS (
  SELECT subject, path, format, page, page_content, meta_source, meta_title, meta_path, meta_page FROM txt_docs
  UNION ALL
  SELECT subject, path, format, page, page_content, meta_source, meta_title, meta_path, meta_page FROM html_docs)"""


def chunk_ctes(src: str, key: str, text: str, size: int, overlap: int, prefix: str = "c") -> str:
    """CTEs ``{prefix}_src`` / ``{prefix}_steps`` / ``{prefix}_chunks``: one
    recursion step per emitted chunk (or per long piece)."""
    st = max(1, size - overlap)
    lo = f"greatest(s, e - {overlap}, e2 - {size})"
    return f"""
{prefix}_src AS (SELECT {key} AS k, {text} AS x, length({text}) AS n FROM {src}),
{prefix}_steps(k, s, done, emitted, it) AS (
  SELECT k, 0, n = 0, CAST([] AS STRUCT(a INTEGER, b INTEGER)[]), 0 FROM {prefix}_src
  UNION ALL
  SELECT k,
    CASE WHEN n - s <= {size} THEN n WHEN e2 - e >= {size} THEN e2
         ELSE {lo} + instr(substring(x, {lo} + 1), ' ') - 1 END,
    CASE WHEN n - s <= {size} THEN true WHEN e2 - e >= {size} THEN e2 >= n ELSE false END,
    CASE WHEN n - s <= {size} THEN [{{'a': s, 'b': n}}]
         WHEN e2 - e >= {size} THEN
           (CASE WHEN e > s THEN [{{'a': s, 'b': e}}] ELSE CAST([] AS STRUCT(a INTEGER, b INTEGER)[]) END)
           || list_transform(range(0, CAST(ceil(greatest(0, e2 - e - {size}) / {st}) AS INTEGER) + 1),
                             lambda w: {{'a': e + w * {st}, 'b': least(e + w * {st} + {size}, e2)}})
         ELSE [{{'a': s, 'b': e}}] END,
    it + 1
  FROM (
    SELECT k, s, n, x, e, it,
           CASE WHEN instr(substring(x, e + 2), ' ') > 0 THEN e + instr(substring(x, e + 2), ' ') ELSE n END AS e2
    FROM (
      SELECT t.k, t.s, t.it, src.n, src.x,
             t.s + length(regexp_extract(substring(src.x, t.s + 2, {size}), '(?s)^.* ', 0)) AS e
      FROM {prefix}_steps t JOIN {prefix}_src src ON t.k = src.k
      WHERE NOT t.done)
  )
),
{prefix}_spans AS (SELECT k, unnest(emitted) AS sp FROM {prefix}_steps),
{prefix}_raw AS (
  SELECT sp.k, sp.sp.a AS char_start, sp.sp.b AS char_end,
         {strip("substring(src.x, sp.sp.a + 1, sp.sp.b - sp.sp.a)") if size > 1 else "substring(src.x, sp.sp.a + 1, sp.sp.b - sp.sp.a)"} AS content
  FROM {prefix}_spans sp JOIN {prefix}_src src ON sp.k = src.k),
{prefix}_chunks AS (
  SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY char_start) - 1 AS INTEGER) AS chunk_index,
         char_start, char_end, content
  FROM {prefix}_raw WHERE length(content) > 0)"""


def norm_txt_docs() -> str:
    return f"""
norm_docs AS (
  SELECT doc_id, subject, path, format, page, {normalise("page_content")} AS page_content,
         meta_source, meta_title, meta_path, meta_page FROM txt_docs)"""


def norm_corpus_docs() -> str:
    return f"""
norm_corpus AS (
  SELECT subject, path, format, page, {normalise("page_content")} AS page_content,
         meta_source, meta_title, meta_path, meta_page FROM corpus_docs)"""


def corpus_chunks_ctes(size: int = 512, overlap: int = 64) -> str:
    """All corpus chunks with parent columns, ``id`` and ``tokens`` as ``corpus_chunks``."""
    return ",".join([TXT_DOCS, PAGE_FILES, HTML_DOCS, CORPUS_DOCS, norm_corpus_docs(),
                     chunk_ctes("norm_corpus", "path", "page_content", size, overlap, "cc"),
                     f"""
corpus_chunks AS (
  SELECT d.subject, d.path, d.format, d.page, d.meta_source, d.meta_title, d.meta_path, d.meta_page,
         c.chunk_index, c.char_start, c.char_end, c.content,
         {stable_id("d.subject", "d.path", "d.page", "c.chunk_index")} AS id,
         CAST({token_count("c.content")} AS INTEGER) AS tokens
  FROM cc_chunks c JOIN norm_corpus d ON c.k = d.path)"""])


def doc_chunks_ctes(size: int = 512, overlap: int = 64) -> str:
    """Chunks of ``documents`` only, as ``doc_chunks`` (with doc_id)."""
    return ",".join([TXT_DOCS, norm_txt_docs(),
                     chunk_ctes("norm_docs", "doc_id", "page_content", size, overlap, "dc"),
                     f"""
doc_chunks AS (
  SELECT d.doc_id, d.subject, d.path, d.page, d.meta_source, d.meta_path,
         c.chunk_index, c.char_start, c.char_end, c.content,
         {stable_id("d.subject", "d.path", "d.page", "c.chunk_index")} AS id,
         CAST({token_count("c.content")} AS INTEGER) AS tokens
  FROM dc_chunks c JOIN norm_docs d ON c.k = d.doc_id)"""])


def store_ctes() -> str:
    """The vector store rows of the whole table corpus, as ``store``."""
    return corpus_chunks_ctes() + "," + hashed_ctes("store", "corpus_chunks", "content")


QUESTIONS = """
question_src AS (SELECT CAST(item_id AS BIGINT) AS query_set_id, text AS question FROM benchmark),""" + \
    hashed_ctes("questions", "question_src", "question")


def text_topk_ctes(k: int = 5, threshold: float = 0.15) -> str:
    """Per question the top-k store chunks, as ``text_top``."""
    return store_ctes() + "," + QUESTIONS + f""",
text_scores AS (
  SELECT q.query_set_id, s.id, {dot("s.embedding", "q.embedding")} AS score
  FROM store s, questions q),
text_top AS (
  SELECT * FROM (
    SELECT query_set_id, id, score, round(score, 6) AS similarity,
           CAST(row_number() OVER (PARTITION BY query_set_id ORDER BY round(score, 12) DESC, id) AS INTEGER) AS rank
    FROM text_scores WHERE NOT isnan(score) AND score >= {threshold})
  WHERE rank <= {k}),
text_results AS (
  SELECT t.query_set_id, t.rank, t.id, t.similarity, s.content, s.meta_source, s.meta_title, s.meta_path,
         s.meta_page, 'cosine_similarity' AS similarity_function, 'feature-hash-64' AS embedding_model
  FROM text_top t JOIN store s ON t.id = s.id)"""
