"""DuckDB SQL building blocks mirroring the Spark corpus pipeline (for the oracle)."""

from ..functions.text import DEFAULT_FILTERS, char_class


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


FILTER_RE = _sql_str(char_class(DEFAULT_FILTERS).replace("\\t", "\\t").replace("\\n", "\\n"))

LINES = """lines AS (
  SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS line_no, unnest(s) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)
)"""

SENTENCES = """sentences AS (
  SELECT * FROM lines WHERE length(line) - length(replace(line, ' ', '')) >= 2
)"""

TOKENS = f"""tokens AS (
  SELECT doc_id, line_no, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos, unnest(ws) AS word
  FROM (SELECT doc_id, line_no,
               list_filter(string_split(regexp_replace(lower(line), {FILTER_RE}, ' ', 'g'), ' '),
                           lambda x: x <> '') AS ws
        FROM sentences)
)"""

VOCAB = """vocab AS (
  SELECT word, CAST(row_number() OVER (ORDER BY n DESC, fd, fl, fp) AS INTEGER) AS word_id, n
  FROM (SELECT word, count(*) AS n,
               arg_min(doc_id, struct_pack(d := doc_id, l := line_no, p := pos)) AS fd,
               arg_min(line_no, struct_pack(d := doc_id, l := line_no, p := pos)) AS fl,
               arg_min(pos, struct_pack(d := doc_id, l := line_no, p := pos)) AS fp
        FROM tokens GROUP BY word)
)"""

ENCODED = """encoded AS (
  SELECT t.doc_id, t.line_no, t.pos, v.word_id FROM tokens t JOIN vocab v USING (word)
)"""

CORPUS = ",\n".join([LINES, SENTENCES, TOKENS, VOCAB, ENCODED])


def with_corpus(body: str) -> str:
    return "WITH " + CORPUS + "\n" + body
