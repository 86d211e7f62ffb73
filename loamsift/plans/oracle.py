"""The registered queries in DuckDB SQL, written independently of the Spark code.

Each query is a chain of common table expressions; ``_sql`` puts together those it names.
"""

from __future__ import annotations

from loamsift.config import SOURCE_CATALOG
from loamsift.functions.stopwords import ENGLISH
from loamsift.plans.queries import DRAW_SIZE, EPOCH, MAX_LENGTH, PREFERENCES, SOME_BATCHES, TOXIC_LIMIT, UNIMAX_BATCHES, UNIMAX_SIZE

# Character classes in the syntax of DuckDB's regex engine.
_WS = (
    r"\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_DIGIT = (
    r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}"
    r"\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)
_UPPER = (
    r"\p{Lu}\x{2160}-\x{216f}\x{24b6}-\x{24cf}"
    r"\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"
)


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[{_WS}]+'), lambda x: x <> '')"


def _uniform(*parts: str) -> str:
    key = "concat_ws(':', " + ", ".join(parts) + ")"
    return f"(concat('0x', substr(md5({key}), 1, 13))::BIGINT / pow(16::DOUBLE, 13))"


def _has(text: str, needles: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{n}')" for n in needles) + ")"


def _when(column: str, values: dict[str, float], other: float) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in values.items())
    return f"(CASE {column} {arms} ELSE {other!r}::DOUBLE END)"


_QUALITY_W = {"high": 1.0, "medium": 0.7, "low": 0.3}
_DOMAIN_W = {"web": 1.0, "books": 0.8, "code": 0.6, "news": 0.5, "academic": 0.4}
_BUCKET_W = {"high": 2.0, "medium": 1.0, "low": 0.5}
_TOXIC = (
    "hate", "violence", "threat", "attack", "kill", "die", "stupid", "idiot",
    "racist", "sexist", "discrimination", "harassment",
)
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
_CATALOG = ", ".join(
    f"('{s.domain}', '{s.dataset}', {'NULL' if s.subset is None else repr(s.subset)}, '{s.split}',"
    f" '{s.text_column}', {s.weight!r}::DOUBLE, {s.max_documents}, {i})"
    for i, s in enumerate(SOURCE_CATALOG)
)

_CODE_DOC = f"({_has('text', ('#', '//', '/*'))})"
_STRUCTURE = _has("lower(text)", ("def", "function", "class", "import", "return"))
_CITES = _has("text", ("et al.", "Figure", "Table", "Abstract"))


def _ingest_quality(domain: str) -> str:
    return f"""CASE
      WHEN {domain} = 'code' THEN CASE
        WHEN {_CODE_DOC} AND {_STRUCTURE} AND nw > 20 THEN 'high'
        WHEN {_STRUCTURE} AND nw > 10 THEN 'medium' ELSE 'low' END
      WHEN {domain} = 'academic' THEN CASE
        WHEN {_CITES} AND wl > 5 AND sr < 1e-1 AND nw > 100 THEN 'high'
        WHEN wl > 5 AND sr < 1e-1 AND nw > 50 THEN 'medium' ELSE 'low' END
      WHEN nw > 100 AND wl > 4 AND sr < 15e-2 AND ur < 3e-1 THEN 'high'
      WHEN nw > 50 AND wl > 3 AND sr < 25e-2 THEN 'medium' ELSE 'low' END"""


def _text_stats(source: str, name: str) -> str:
    return f"""{name} AS (
      SELECT *, len(w) AS nw, length(text) AS nc,
        length(array_to_string(w, '')) / greatest(len(w), 1) AS wl,
        len(list_distinct(w)) / greatest(len(w), 1) AS uw,
        length(regexp_replace(text, '[\\p{{L}}\\p{{N}}{_WS}]', '', 'g')) / greatest(length(text), 1) AS sr,
        length(regexp_replace(text, '[^{_DIGIT}]', '', 'g')) / greatest(length(text), 1) AS dr,
        length(regexp_replace(text, '[^{_UPPER}]', '', 'g')) / greatest(length(text), 1) AS ur,
        len(regexp_extract_all(text, 'http[s]?://[^{_WS}]+')) / greatest(len(w), 1) AS lr,
        1 - len(list_distinct(ln)) / len(ln) AS dup
      FROM (SELECT *, {_words('text')} AS w, string_split(text, chr(10)) AS ln FROM {source}))"""


_LINES = f"list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^{_WS}]'))"
_COMMENTS = f"list_filter({_LINES}, lambda l: regexp_matches(l, '^[{_WS}]*(#|//)|/\\*'))"
_CODE_LENGTH_OK = f"len({_LINES}) BETWEEN 5 AND 20000"
_CODE_COMMENT_OK = f"len({_COMMENTS}) / greatest(len({_LINES}), 1) BETWEEN 1e-3 AND 85e-2"


def _checks(domain: str) -> str:
    def on_words(check: str) -> str:
        return f"CASE WHEN nw > 0 THEN {check} END"

    return f"""
      {on_words('nw BETWEEN 50 AND 100000')} AS length_ok,
      {on_words('wl BETWEEN 3 AND 10')} AS word_length_ok,
      {on_words('sr <= 25e-2')} AS non_alpha_ok,
      {on_words('dr <= 15e-2')} AS number_ratio_ok,
      {on_words('lr <= 2e-1')} AS url_ratio_ok,
      {on_words('dup <= 3e-1')} AS duplicate_lines_ok,
      {on_words(f"CASE WHEN {domain} = 'code' THEN {_CODE_LENGTH_OK} END")} AS code_length_ok,
      {on_words(f"CASE WHEN {domain} = 'code' THEN {_CODE_COMMENT_OK} END")} AS code_comment_ok,
      CASE WHEN nw = 0 THEN 'empty_text' END AS reason"""


_PASSES = """(reason IS NULL AND length_ok AND word_length_ok AND non_alpha_ok AND number_ratio_ok AND url_ratio_ok
      AND duplicate_lines_ok AND coalesce(code_length_ok, true) AND coalesce(code_comment_ok, true))"""


def _annotated(source: str, name: str) -> str:
    toxic = " + ".join(f"contains(lower(text), '{t}')::INT" for t in _TOXIC)
    return f"""{name} AS (
      SELECT *, CASE WHEN ppl <= 5000 AND passes AND ppl <= 1500 THEN 'high'
          WHEN ppl <= 5000 AND passes AND ppl <= 3500 THEN 'medium' ELSE 'low' END AS quality_class,
        greatest(0::DOUBLE, 1 - ppl / 10000::DOUBLE) AS quality_score,
        least(({toxic}) / 10::DOUBLE, 1::DOUBLE) AS toxicity_score, md5(text) AS hash_id
      FROM (SELECT *, {_PASSES} AS passes FROM (
        SELECT *, {_checks('domain')}, {_ingest_quality('domain')} AS quality,
          CASE WHEN nw = 0 THEN 'infinity'::DOUBLE
            ELSE least(1000 * (1 / (wl * uw + 1e-1)), 10000::DOUBLE) END AS ppl
        FROM {source})))"""


_CTES: dict[str, str] = {
    "docs": """docs AS (
      SELECT doc_id, text, source, lang, CASE WHEN k >= 19 THEN 'academic' WHEN k >= 16 THEN 'news'
        WHEN k >= 13 THEN 'code' WHEN k >= 8 THEN 'books' WHEN k >= 0 THEN 'web' END AS domain
      FROM (SELECT *, substr(source, 4)::INT AS k FROM documents))""",
    "catalog": f"""catalog(domain, dataset, subset, split, text_column, weight, max_documents, i) AS (
      VALUES {_CATALOG})""",
    "others": """others AS (
      SELECT 'conversations' AS domain, conv_id AS doc_id, text FROM conversations
      UNION ALL SELECT 'benchmark', item_id, text FROM benchmark
      UNION ALL SELECT 'pages', page_id, html FROM pages)""",
    "st": _text_stats("docs", "st"),
    "ann": _annotated("st", "ann"),
    "firsts": "firsts AS (SELECT md5(text) AS h, min(doc_id) AS f, count(*) AS n FROM docs GROUP BY 1)",
    "ex": "ex AS (SELECT d.* FROM docs d JOIN firsts ON d.doc_id = f)",
    "pr": "pr AS (SELECT a.* FROM ann a JOIN firsts ON a.doc_id = f)",
    # sources
    "pre": """pre AS (
      SELECT * FROM (
        SELECT d.*, max_documents, row_number() OVER (PARTITION BY d.domain ORDER BY doc_id) AS r
        FROM docs d JOIN catalog c ON c.domain = d.domain)
      WHERE r <= 3 * max_documents AND length(text) > 0)""",
    "sam": f"""sam AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {_uniform("'42'", 'doc_id')}, doc_id) AS q FROM pre)
      WHERE q <= max_documents)""",
    "samst": _text_stats("sam", "samst"),
    # near duplicates
    "grams": f"""grams AS (
      SELECT doc_id, CASE
        WHEN len(t) >= 3 THEN list_distinct(list_transform(range(1, len(t) - 1),
          lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))
        WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END AS g
      FROM (SELECT doc_id, {_words('lower(text)')} AS t FROM ex))""",
    "posts": "posts AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM grams)",
    "freq": "freq AS (SELECT gram, count(*) AS c FROM posts GROUP BY 1 HAVING count(*) > 1)",
    "pairs": """pairs AS (
      SELECT a.doc_id AS i, b.doc_id AS j, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS sim
      FROM (SELECT * FROM posts SEMI JOIN freq USING (gram)) a
      JOIN (SELECT * FROM posts SEMI JOIN freq USING (gram)) b ON a.gram = b.gram AND a.doc_id < b.doc_id
      GROUP BY 1, 2 HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*)) >= 0.6 - 1e-9)""",
    "ordered": """ordered AS (
      SELECT d, row_number() OVER (ORDER BY d) AS o, nb FROM (
        SELECT d, list(i) FILTER (i IS NOT NULL) AS nb FROM (
          SELECT i AS d, NULL AS i FROM pairs UNION ALL SELECT j, i FROM pairs) GROUP BY d))""",
    "walk": """walk AS (
      SELECT 0::BIGINT AS o, []::BIGINT[] AS kept, NULL::BIGINT AS d, NULL::BIGINT AS m
      UNION ALL
      SELECT o, CASE WHEN m IS NULL THEN list_append(kept, d) ELSE kept END, d, m FROM (
        SELECT ordered.o, w.kept, ordered.d,
          list_min(list_intersect(w.kept, coalesce(ordered.nb, []::BIGINT[]))) AS m
        FROM walk w JOIN ordered ON ordered.o = w.o + 1))""",
    "gone": "gone AS (SELECT d AS doc_id, m AS kept_id FROM walk WHERE m IS NOT NULL)",
    "done": "done AS (SELECT p.* FROM pr p ANTI JOIN gone USING (doc_id))",
    # a trained bigram model of the target documents
    "bg": f"""bg AS (
      SELECT doc_id, unnest(list_concat([' <'], w[1:len(w) - 1])) AS v, unnest(w) AS w
      FROM (SELECT doc_id, list_concat({_words("lower(coalesce(text, ''))")}, [' >']) AS w FROM pr))""",
    "tb": "tb AS (SELECT v, w, count(*) AS c FROM bg SEMI JOIN tgt USING (doc_id) GROUP BY v, w)",
    "cx": "cx AS (SELECT v, sum(c) AS t, count(*) AS f FROM tb GROUP BY v)",
    "wd": """wd AS (
      SELECT w, (count(*) - 75e-2) / (SELECT count(*) FROM tb)
        + 75e-2 * count(*) OVER () / (SELECT count(*) FROM tb) / (count(*) OVER () + 1) AS p FROM tb GROUP BY w)""",
    "bp": """bp AS (
      SELECT doc_id, count(*) AS n_tokens, count(c) AS n_known, -sum(log10(coalesce((c - 75e-2) / t, 0) + coalesce(75e-2 * f / t, 1)
        * coalesce(p, (SELECT 75e-2 * count(*) / (SELECT count(*) FROM tb) / (count(*) + 1) FROM wd)))) / count(*) AS l
      FROM bg LEFT JOIN tb USING (v, w) LEFT JOIN cx USING (v) LEFT JOIN wd USING (w) GROUP BY doc_id)""",
    # selection
    "tgt": """tgt AS (
      SELECT doc_id, text FROM pr WHERE quality_class = 'high'
      UNION ALL SELECT doc_id, text FROM pr
      WHERE quality_class = 'medium' AND (SELECT count(*) FROM pr WHERE quality_class = 'high') < 10)""",
    "toks": f"""toks AS (
      SELECT doc_id, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS terms
      FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
        lambda w: w NOT IN ({_STOP})) AS t FROM docs))""",
    "tf": """tf AS (
      SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM toks) GROUP BY 1, 2)""",
    "vocab": """vocab AS (
      SELECT term, count(*) AS df, sum(tf)::BIGINT AS total,
        ln((1 + (SELECT count(*) FROM tgt)) / (1 + count(*))) + 1 AS idf
      FROM tf SEMI JOIN tgt USING (doc_id) GROUP BY term
      HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT count(*) FROM tgt)
      ORDER BY total DESC, term LIMIT 10000)""",
    "vec": """vec AS (
      SELECT doc_id, term, tf, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY doc_id)) AS x
      FROM tf JOIN vocab USING (term) SEMI JOIN pr USING (doc_id))""",
    "pt": """pt AS (
      SELECT term, m / sum(m) OVER () AS p FROM (
        SELECT term, sum(x) / (SELECT count(*) FROM tgt) AS m FROM vec SEMI JOIN tgt USING (doc_id) GROUP BY term))""",
    "ps": """ps AS (
      SELECT term, m / (sum(m) OVER () + 1e-10) AS p FROM (
        SELECT term, sum(x) / (SELECT count(*) FROM pr) AS m FROM vec GROUP BY term))""",
    "imp": """imp AS (
      SELECT term, least(10::DOUBLE, greatest(1e-1, coalesce(pt.p, 0) / (coalesce(ps.p, 0) + 1e-10))) AS weight
      FROM vocab LEFT JOIN pt USING (term) LEFT JOIN ps USING (term))""",
    "dsir": """dsir AS (
      SELECT pr.doc_id, round(coalesce(s, 0), 6) AS dsir FROM pr LEFT JOIN (
        SELECT doc_id, sum(x * weight) AS s FROM vec JOIN imp USING (term) GROUP BY 1) USING (doc_id))""",
    "att": f"""att AS (
      SELECT doc_id, domain, {_when('quality_class', _QUALITY_W, 0.5)} + {_when('domain', _DOMAIN_W, 0.5)} AS att,
        quality_score, toxicity_score FROM pr)""",
    "hyb": """hyb AS (
      SELECT doc_id, dn, an, round(6e-1 * dn + 4e-1 * an, 6) AS score FROM (
        SELECT doc_id,
          (dsir - min(dsir) OVER ()) / (max(dsir) OVER () - min(dsir) OVER () + 1e-10) AS dn,
          (att - min(att) OVER ()) / (max(att) OVER () - min(att) OVER () + 1e-10) AS an
        FROM dsir JOIN att USING (doc_id)))""",
    "hsel": """hsel AS (
      SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) - 1 AS r FROM hyb)
      WHERE r < floor((SELECT count(*) FROM pr) * 0.95::DOUBLE))""",
    "dps": """dps AS (
      SELECT domain, term, m / (sum(m) OVER (PARTITION BY domain) + 1e-10) AS p FROM (
        SELECT domain, term, sum(x) / any_value(n) AS m FROM vec JOIN pr USING (doc_id)
        JOIN (SELECT domain, count(*) AS n FROM pr GROUP BY 1) USING (domain) GROUP BY 1, 2))""",
    "dsc": """dsc AS (
      SELECT pr.doc_id, pr.domain, round(coalesce(s, 0), 6) AS score FROM pr LEFT JOIN (
        SELECT vec.doc_id, sum(x * least(10::DOUBLE, greatest(1e-1, coalesce(pt.p, 0) / (dps.p + 1e-10)))) AS s
        FROM vec JOIN pr USING (doc_id) JOIN dps ON dps.domain = pr.domain AND dps.term = vec.term
        LEFT JOIN pt ON pt.term = vec.term GROUP BY 1) USING (doc_id))""",
    # sampling
    "grp": """grp AS (
      SELECT domain, count(*) AS n, min(doc_id) AS first_id, count(*) / (SELECT count(*) FROM docs) AS p,
        row_number() OVER (ORDER BY min(doc_id)) - 1 AS i
      FROM docs GROUP BY 1)""",
    "bkt": "bkt AS (SELECT doc_id, domain || '_' || quality_class AS bucket, quality_class FROM pr)",
    "bgrp": f"""bgrp AS (
      SELECT bucket, n, first_id, w / sum(w) OVER () AS w FROM (
        SELECT bucket, count(*) AS n, min(doc_id) AS first_id,
          {_when('any_value(quality_class)', _BUCKET_W, 1.0)} * (count(*) / (SELECT count(*) FROM bkt)) AS w
        FROM bkt GROUP BY 1))""",
}

# What each expression above builds on, in order.
_NEEDS: dict[str, tuple[str, ...]] = {
    "st": ("docs",), "ann": ("st",), "firsts": ("docs",), "ex": ("firsts",), "pr": ("ann", "firsts"),
    "pre": ("docs", "catalog"), "sam": ("pre",), "samst": ("sam",),
    "grams": ("ex",), "posts": ("grams",), "freq": ("posts",), "pairs": ("freq",), "ordered": ("pairs",),
    "walk": ("ordered",), "gone": ("walk",), "done": ("pr", "gone"),
    "bg": ("pr",), "tb": ("bg", "tgt"), "cx": ("tb",), "wd": ("tb",), "bp": ("bg", "cx", "wd"),
    "tgt": ("pr",), "toks": ("docs",), "tf": ("toks",), "vocab": ("tf", "tgt"), "vec": ("vocab", "pr"),
    "pt": ("vec", "tgt"), "ps": ("vec", "pr"), "imp": ("pt", "ps"), "dsir": ("imp",), "att": ("pr",),
    "hyb": ("dsir", "att"), "hsel": ("hyb",), "dps": ("vec",), "dsc": ("dps", "pt"),
    "grp": ("docs",), "bkt": ("pr",), "bgrp": ("bkt",),
}


def _sql(needs: str, body: str, extra: str = "") -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    parts = [_CTES[n] for n in order] + ([extra] if extra else [])
    recursive = "RECURSIVE " if "walk" in order or extra else ""
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + body


_RAW_COLUMNS = """doc_id, domain, {quality} AS quality, source, md5(text) AS text_md5, nc::INTEGER AS length,
  nw::INTEGER AS word_count, source AS original_dataset, CASE WHEN domain = 'code' THEN {language} END AS language"""
_RAW = _sql(
    "st", f"SELECT {_RAW_COLUMNS.format(quality=_ingest_quality('domain'), language='lang')} FROM st"
)


def _processed_columns(perplexity: str) -> str:
    return f"""doc_id, domain, quality_class, round(quality_score, 6) AS quality_score,
  round(toxicity_score, 6) AS toxicity_score, hash_id, false AS is_duplicate, round({perplexity}, 6) AS perplexity,
  quality AS original_quality, passes, reason"""


_SELECTED = _sql("hsel", """SELECT h.doc_id, pr.domain, pr.quality_class AS quality, round(score, 6) AS selection_score,
  round(dn, 6) AS dsir_score, round(an, 6) AS attribute_score, r AS selection_rank, 'hybrid' AS selected_by
FROM hsel h JOIN pr USING (doc_id)""")


def _ranked(needs: str, source: str, score: str, by: str) -> str:
    return _sql(needs, f"""SELECT doc_id, domain, round({score}, 6) AS selection_score, r AS selection_rank, '{by}' AS selected_by
FROM (SELECT *, row_number() OVER (ORDER BY {score} DESC, doc_id) - 1 AS r FROM {source})
WHERE r < floor((SELECT count(*) FROM {source}) * 0.95::DOUBLE)""")


_UNIMAX = _sql("grp", f"""SELECT r * (SELECT count(*) FROM grp) + i AS position, doc_id, domain FROM (
  SELECT doc_id, domain, i,
    row_number() OVER (PARTITION BY domain ORDER BY {_uniform("'42'", "0", 'doc_id')}, doc_id) - 1 AS r
  FROM docs JOIN grp USING (domain))
WHERE r * (SELECT count(*) FROM grp) + i
  < (SELECT least({UNIMAX_SIZE}, min(n * (SELECT count(*) FROM grp) + i)) FROM grp)""")

_COMPOSITION = _sql("pr", f"""SELECT domain, count(*) AS count FROM (
  SELECT doc_id, domain, i, n, row_number() OVER (PARTITION BY domain ORDER BY {_uniform("'42'", "0", 'doc_id')}, doc_id) - 1 AS r
  FROM pr JOIN g USING (domain))
WHERE r * (SELECT count(*) FROM g) + i < (SELECT least({UNIMAX_SIZE}, min(n * (SELECT count(*) FROM g) + i)) FROM g)
GROUP BY 1""", extra="""g AS (SELECT domain, count(*) AS n, row_number() OVER (ORDER BY min(doc_id)) - 1 AS i FROM pr GROUP BY 1)""")

_SIZE, _BATCHES = UNIMAX_BATCHES
_UNIMAX_BATCHES = _sql(
    "grp",
    f"""SELECT s.batch_id, s.position, d.doc_id, s.domain FROM (
  SELECT b AS batch_id, i + t * nd AS position, domain, used[i + 1] + t AS r FROM (
    SELECT b, used, stop, domain, i, nd, unnest(range(greatest(0, ceil((stop - i) / nd))::BIGINT)) AS t
    FROM steps, grp, (SELECT count(*) AS nd FROM grp) WHERE b < {_BATCHES})) s
JOIN (
  SELECT doc_id, domain, row_number() OVER (PARTITION BY domain ORDER BY e, {_uniform("'42'", "e", 'doc_id')}, doc_id) - 1 AS r
  FROM docs, (VALUES (0), (1)) epochs(e)) d ON d.domain = s.domain AND d.r = s.r""",
    extra=f"""sizes AS (SELECT list(2 * n ORDER BY i) AS n, count(*)::BIGINT AS nd FROM grp),
steps AS (
  SELECT 0 AS b, list_transform(n, lambda x: 0::BIGINT) AS used,
    least({_SIZE}, list_min(list_transform(range(nd), lambda k: n[k + 1] * nd + k)))::BIGINT AS stop FROM sizes
  UNION ALL
  SELECT b + 1, now, least({_SIZE}, list_min(list_transform(range(nd), lambda k: (n[k + 1] - now[k + 1]) * nd + k)))::BIGINT
  FROM (
    SELECT b, n, nd, list_transform(range(nd),
      lambda k: used[k + 1] + greatest(0, ceil((stop - k) / nd))::BIGINT) AS now
    FROM steps, sizes WHERE b < {_BATCHES}))""",
)


def _draws(needs: str, groups: str, members: str, by: str, size: str) -> str:
    """``groups`` gives (by, n, first_id, mass); ``members`` is a table of (doc_id, by)."""
    return _sql(needs, f"""SELECT draw, m.doc_id, p.{by} FROM (
  SELECT draw, {by}, floor({_uniform("'42:member'", 'draw')} * n)::BIGINT AS r
  FROM (SELECT unnest(range({size})) AS draw)
  JOIN edges ON {_uniform("'42:group'", 'draw')} >= lo AND {_uniform("'42:group'", 'draw')} < hi) p
JOIN (SELECT doc_id, {by}, row_number() OVER (PARTITION BY {by} ORDER BY doc_id) - 1 AS r FROM {members}) m
  ON m.{by} = p.{by} AND m.r = p.r""", extra=f"""mass AS ({groups}),
edges AS (
  SELECT {by}, n, coalesce(lag(upto) OVER (ORDER BY first_id), 0) AS lo,
    CASE WHEN lead(first_id) OVER (ORDER BY first_id) IS NULL THEN 2 ELSE upto END AS hi
  FROM (SELECT *, sum(mass) OVER (ORDER BY first_id) / (SELECT sum(mass) FROM mass) AS upto FROM mass))""")


_ALPHA_P = "pow(p, 1.3::DOUBLE) / (SELECT sum(pow(p, 1.3::DOUBLE)) FROM grp)"
_PREF_TOTAL = sum(PREFERENCES.values())
_PREF_W = _when("domain", {k: v / _PREF_TOTAL for k, v in PREFERENCES.items()}, 0.1)
_N_DRAWS = f"least({DRAW_SIZE}, (SELECT count(*) FROM docs))"

_CODES = f"""list_concat([1], list_concat(list_transform(regexp_extract_all(lower(text), '(?s).'), lambda c: CASE
    WHEN regexp_matches(c, '[\\p{{L}}\\p{{N}}]') THEN unicode(c) % 31900 + 100
    WHEN regexp_matches(c, '[{_WS}]') THEN 50 ELSE 51 END), [2]))"""
_PADDED = f"""list_concat(t[1:{MAX_LENGTH}], list_transform(range(greatest({MAX_LENGTH} - len(t), 0)), lambda i: 0))"""
_CODED = f"(SELECT doc_id, {_CODES} AS t FROM docs)"

_ORDER = f"""WITH RECURSIVE sizes AS (
  SELECT n, a, ceil(n / a)::BIGINT AS b FROM (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM documents)
), steps AS (
  SELECT doc_id, k // b AS x, k % b AS y, 0 AS r FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents), sizes
  UNION ALL
  SELECT doc_id, x, (y + floor({_uniform(f"'42:{EPOCH}'", "r % 6", "'y'", "x")} * b)::BIGINT) % b, r + 1 FROM (
    SELECT doc_id, (x + floor({_uniform(f"'42:{EPOCH}'", "r % 6", "'x'", "y")} * a)::BIGINT) % a AS x, y, r, b
    FROM steps, sizes WHERE r % 6 > 0 OR r = 0 OR x * b + y >= n)
), placed AS (
  SELECT doc_id, x * b + y AS p FROM steps, sizes WHERE r > 0 AND r % 6 = 0 AND x * b + y < n
)
SELECT doc_id, p // 8 AS batch_id, (p % 8)::INTEGER AS place FROM placed"""
_DOMAINS = ", ".join(f"('{s.domain}')" for s in SOURCE_CATALOG)
_ORDER_OF_DOMAINS = f"list_position([{', '.join(repr(s.domain) for s in SOURCE_CATALOG)}], domain)"
_SOURCE_COUNTS = "(SELECT domain, count(*) AS a FROM docs GROUP BY 1)"

ORACLE: dict[str, str] = {
    "source_catalog": _sql("docs catalog", f"""SELECT c.domain, dataset, subset, split, text_column, weight, max_documents,
  coalesce(a, 0) AS available, least(coalesce(a, 0), 3 * max_documents) AS prefix_rows
FROM catalog c LEFT JOIN {_SOURCE_COUNTS} n ON n.domain = c.domain"""),
    "scan_source": _sql("others", "SELECT domain, doc_id, length(text)::INTEGER AS n_chars, md5(text) AS text_md5 FROM others"),
    "prefix_scan": _sql("pre", "SELECT doc_id, domain, length(text)::INTEGER AS n_chars FROM pre"),
    "sample_source": _sql("sam", "SELECT doc_id, domain, length(text)::INTEGER AS n_chars FROM sam"),
    "ingest_length_filter": _sql("st", "SELECT doc_id, domain FROM st WHERE nw BETWEEN 10 AND 10000"),
    "raw_documents": _RAW,
    "ingest_sources": _sql("samst", f"""SELECT row_number() OVER (ORDER BY i, doc_id) - 1 AS doc_id, * EXCLUDE (doc_id, i) FROM (
  SELECT {_RAW_COLUMNS.format(quality=_ingest_quality('samst.domain'), language='lang')}, c.i
  FROM samst JOIN (SELECT domain AS d, row_number() OVER (ORDER BY {_ORDER_OF_DOMAINS}) AS i FROM (VALUES {_DOMAINS}) v(domain)) c ON c.d = samst.domain
  WHERE nw BETWEEN 10 AND 10000)"""),
    "file_positions": """SELECT row_number() OVER (ORDER BY CASE WHEN lang = 'en' THEN 1 WHEN lang < 'en' THEN 0 ELSE 2 END, doc_id) - 1 AS doc_id,
  md5(text) AS text_md5 FROM documents""",
    "ingest_overlapping": f"""WITH RECURSIVE rows AS (
  SELECT 0 AS s, 'web' AS domain, doc_id AS k, text FROM documents
  UNION ALL SELECT 1, 'conversations', row_number() OVER (), text FROM conversations
  UNION ALL SELECT 2, 'benchmark', item_id, text FROM benchmark
  UNION ALL SELECT 3, 'pages', page_id, html FROM pages
), numbered AS (
  SELECT row_number() OVER (ORDER BY s, k) - 1 AS doc_id, domain, text, md5(text) AS hash_id FROM rows
  WHERE len({_words('text')}) BETWEEN 10 AND 10000
), ex AS (
  SELECT min(doc_id) AS doc_id, arg_min(domain, doc_id) AS domain, any_value(text) AS text, hash_id FROM numbered GROUP BY hash_id
), {", ".join(_CTES[name] for name in ("grams", "posts", "freq", "pairs", "ordered", "walk", "gone"))}
SELECT doc_id, domain, hash_id FROM ex ANTI JOIN gone USING (doc_id)""",
    "domain_mix_gap": _sql("docs catalog", f"""SELECT coalesce(c.domain, n.domain) AS domain, coalesce(weight, 0) AS weight,
  round(coalesce(a, 0) / (SELECT count(*) FROM docs), 6) AS share,
  round(coalesce(a, 0) / (SELECT count(*) FROM docs) - coalesce(weight, 0), 6) AS gap
FROM catalog c FULL JOIN {_SOURCE_COUNTS} n ON n.domain = c.domain"""),
    "union_sources": _sql(
        "docs others", f"SELECT domain, {_ingest_quality('domain')} AS quality, count(*) AS count FROM allst GROUP BY 1, 2",
        extra="alls AS (SELECT domain, doc_id, text FROM docs UNION ALL SELECT * FROM others),\n" + _text_stats("alls", "allst"),
    ),
    "jsonl_roundtrip": _RAW,
    "processed_sink": _sql("pr", f"SELECT {_processed_columns('CASE WHEN isfinite(ppl) THEN ppl END')} FROM pr"),
    "selected_sink": _SELECTED,
    "raw_stats": _sql("docs", """SELECT (SELECT count(*) FROM docs) AS total_documents, domain, count(*) AS documents
FROM docs GROUP BY domain"""),
    "processing_stats": _sql("pr", """SELECT t.*, d.* FROM (
  SELECT count(*) AS total_processed, count(*) FILTER (quality_class = 'high') AS high,
    count(*) FILTER (quality_class = 'medium') AS medium, count(*) FILTER (quality_class = 'low') AS low,
    round(avg(quality_score), 6) AS avg_quality_score, round(avg(toxicity_score), 6) AS avg_toxicity_score FROM pr) t,
  (SELECT domain, count(*) AS documents FROM pr GROUP BY 1) d"""),
    "stage_counts": _sql("done", """SELECT 'raw' AS stage, (SELECT count(*) FROM docs) AS rows
UNION ALL SELECT 'processed', (SELECT count(*) FROM done)
UNION ALL SELECT 'selected', (SELECT floor(count(*) * 0.95::DOUBLE)::BIGINT FROM done)
UNION ALL SELECT 'sampled', (SELECT floor(count(*) * 0.95::DOUBLE)::BIGINT FROM done)
UNION ALL SELECT 'train', (SELECT floor(floor(count(*) * 0.95::DOUBLE) * 0.8::DOUBLE)::BIGINT FROM done)
UNION ALL SELECT 'eval', (SELECT (floor(count(*) * 0.95::DOUBLE)
  - floor(floor(count(*) * 0.95::DOUBLE) * 0.8::DOUBLE))::BIGINT FROM done)"""),
    "estimate_quality": _sql("st", f"SELECT doc_id, domain, {_ingest_quality('domain')} AS quality FROM st"),
    "estimate_quality_code": _sql("st", f"SELECT doc_id, domain, {_ingest_quality(chr(39) + 'code' + chr(39))} AS quality FROM st"),
    "estimate_quality_academic": _sql(
        "st", f"SELECT doc_id, domain, {_ingest_quality(chr(39) + 'academic' + chr(39))} AS quality FROM st"
    ),
    "perplexity_score": _sql("ann", "SELECT doc_id, round(ppl, 6) AS perplexity FROM ann"),
    "heuristic_filters": _sql("ann", """SELECT doc_id, length_ok, word_length_ok, non_alpha_ok, number_ratio_ok, url_ratio_ok,
  duplicate_lines_ok, code_length_ok, code_comment_ok, reason, passes FROM ann"""),
    "page_filters": (
        "WITH p AS (SELECT page_id, html AS text, 'web' AS domain FROM pages),\n"
        + _text_stats("p", "pst") + ",\n" + _annotated("pst", "pan")
        + "\nSELECT page_id, url_ratio_ok, non_alpha_ok, number_ratio_ok, word_length_ok, passes FROM pan"
    ),
    "code_filters": _sql("docs", f"SELECT doc_id, {_CODE_LENGTH_OK} AS code_length_ok, {_CODE_COMMENT_OK} AS code_comment_ok FROM docs"),
    "quality_class": _sql("ann", "SELECT doc_id, domain, quality_class FROM ann"),
    "quality_score": _sql("ann", "SELECT doc_id, round(quality_score, 6) AS quality_score FROM ann"),
    "toxicity_score": _sql("ann", "SELECT doc_id, round(toxicity_score, 6) AS toxicity_score FROM ann"),
    "annotate_quality": _sql("pr", f"SELECT {_processed_columns('ppl')} FROM pr"),
    "quality_drop": _sql("pr", "SELECT doc_id, domain, quality_class FROM pr WHERE passes AND quality_class <> 'low'"),
    "toxicity_filter": _sql("pr", f"""SELECT doc_id, CASE WHEN toxicity_score < {TOXIC_LIMIT}::DOUBLE THEN 'below' ELSE 'above' END AS side
FROM pr"""),
    "ngram_signature": _sql("docs", f"""SELECT doc_id, len(g)::INTEGER AS n_grams, md5(array_to_string(list_sort(g), '|')) AS grams_md5 FROM (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(t) - 1, 1)),
    lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) AS g
  FROM (SELECT doc_id, {_words('lower(text)')} AS t FROM docs))"""),
    "content_hashes": "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents",
    "bigram_model": _sql("cx wd", """SELECT 'pairs' AS part, count(*) AS rows, round(avg((c - 75e-2) / t), 6) AS mean FROM tb JOIN cx USING (v)
UNION ALL SELECT 'contexts', count(*), round(avg(75e-2 * f / t), 6) FROM cx
UNION ALL SELECT 'words', count(*), round(avg(p), 6) FROM wd"""),
    "bigram_perplexity": _sql("bp", "SELECT doc_id, n_tokens, n_known, round(l, 6) AS log10_perplexity FROM bp"),
    "bigram_filter": _sql("bp", "SELECT doc_id, domain FROM bp JOIN pr USING (doc_id) WHERE l <= log10(5000::DOUBLE)"),
    "exact_dedup": _sql("ex", "SELECT doc_id, domain, md5(text) AS hash_id, false AS is_duplicate FROM ex"),
    "exact_dedup_last": _sql("docs", """SELECT max(doc_id) AS doc_id, arg_max(domain, doc_id) AS domain, md5(text) AS text_md5
FROM docs GROUP BY md5(text)"""),
    "exact_dup_flags": _sql("firsts", """SELECT doc_id, h AS hash_id, doc_id > f AS is_duplicate
FROM docs JOIN firsts ON h = md5(text)"""),
    "exact_dup_audit": _sql("firsts", """SELECT doc_id, h AS hash_id, f AS first_doc_id
FROM docs JOIN firsts ON h = md5(text) WHERE doc_id > f"""),
    "exact_dedup_incremental": _sql("docs catalog", """SELECT doc_id, hash_id, batch FROM (
  SELECT doc_id, md5(text) AS hash_id, i AS batch, row_number() OVER (PARTITION BY md5(text) ORDER BY i, doc_id) AS r
  FROM docs JOIN catalog USING (domain)) WHERE r = 1"""),
    "exact_dedup_store": _sql("docs catalog", """SELECT doc_id, hash_id, batch FROM (
  SELECT doc_id, md5(text) AS hash_id, i AS batch, row_number() OVER (PARTITION BY md5(text) ORDER BY i, doc_id) AS r
  FROM docs JOIN catalog USING (domain)) WHERE r = 1"""),
    "shingle_profile": _sql("grams freq", """SELECT doc_id, n::INTEGER AS n_shingles, s::INTEGER AS n_shared,
  (CASE WHEN n = 0 THEN 0 ELSE greatest(s - ceil(0.6::DOUBLE * n - 1e-9) + 1, 0) END)::INTEGER AS n_prefix
FROM (SELECT g.doc_id, any_value(len(g.g)) AS n, count(f.gram) AS s FROM grams g
  LEFT JOIN posts p ON p.doc_id = g.doc_id LEFT JOIN freq f ON f.gram = p.gram GROUP BY 1)"""),
    "fuzzy_matches": _sql("gone", """SELECT doc_id, kept_id, round(sim, 6) AS similarity
FROM gone JOIN pairs ON i = kept_id AND j = doc_id"""),
    "fuzzy_dedup": _sql("gone", """SELECT ex.doc_id, kept_id IS NOT NULL AS is_duplicate, md5(k.text) AS similar_to
FROM ex LEFT JOIN gone USING (doc_id) LEFT JOIN docs k ON k.doc_id = kept_id"""),
    "process_dataset": _sql("done", f"SELECT {_processed_columns('ppl')} FROM done"),
    "quality_distribution": _sql("pr", """SELECT c AS quality_class, count(doc_id) AS count
FROM (VALUES ('high'), ('medium'), ('low')) v(c) LEFT JOIN pr ON quality_class = c GROUP BY 1"""),
    "quality_by_domain": _sql("pr", "SELECT domain, quality_class, count(*) AS count FROM pr GROUP BY 1, 2"),
    "domain_distribution": _sql("ex", "SELECT domain, count(*) AS count FROM ex GROUP BY 1"),
    "avg_scores": _sql("pr", """SELECT round(avg(quality_score), 6) AS avg_quality_score,
  round(avg(toxicity_score), 6) AS avg_toxicity_score FROM pr"""),
    "ingest_quality_by_domain": _sql("ann", "SELECT domain, quality, count(*) AS count FROM ann GROUP BY 1, 2"),
    "domain_statistics": _sql("grp", "SELECT domain, n AS count, round(p, 6) AS proportion, first_id FROM grp"),
    "attribute_buckets": _sql("bkt", "SELECT bucket, count(*) AS count FROM bkt GROUP BY 1"),
    "attribute_buckets_grouped": _sql("pr", "SELECT quality_class AS bucket, count(*) AS count FROM pr GROUP BY 1"),
    "batch_composition": _COMPOSITION,
    "sampler_choice": _sql("docs", """SELECT count(*) AS rows, count(*) FILTER (domain = 'code') AS code_rows,
  CASE WHEN count(*) FILTER (domain = 'code') > 0.3::DOUBLE * count(*) THEN 'alpha' ELSE 'unimax' END AS method FROM docs"""),
    "target_docs": _sql("tgt", "SELECT doc_id, md5(text) AS text_md5 FROM tgt"),
    "selection_guard": _sql("pr", """SELECT c AS target_class, t AS targets, t >= 5 AS "select" FROM (
  SELECT c, count(*) FILTER (quality_class = c) + CASE WHEN count(*) FILTER (quality_class = c) < 10
    THEN count(*) FILTER (quality_class = 'medium') ELSE 0 END AS t
  FROM pr, (VALUES ('high'), ('medium'), ('low')) v(c) GROUP BY c)"""),
    "dsir_terms": _sql("toks", """SELECT doc_id, len(terms)::INTEGER AS n_terms, md5(array_to_string(terms, '|')) AS terms_md5
FROM toks"""),
    "tfidf_vocab": _sql("vocab", "SELECT term, df, total, round(idf, 6) AS idf FROM vocab"),
    "tfidf_vectors": _sql("vec", "SELECT doc_id, term, tf, round(x, 6) AS tfidf FROM vec"),
    "target_distribution": _sql("pt", "SELECT term, round(p, 9) AS p FROM pt"),
    "source_distribution": _sql("ps", "SELECT term, round(p, 9) AS p FROM ps"),
    "importance_weights": _sql("imp", "SELECT term, round(weight, 6) AS weight FROM imp"),
    "dsir_scores": _sql("dsir", "SELECT doc_id, dsir FROM dsir"),
    "dsir_select": _ranked("dsir", "(SELECT * FROM dsir JOIN pr USING (doc_id))", "dsir", "dsir"),
    "dsir_select_per_source": _sql("dsc", """SELECT doc_id, domain, score AS selection_score, r AS selection_rank, 'dsir' AS selected_by
FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, doc_id) - 1 AS r,
  count(*) OVER (PARTITION BY domain) AS n FROM dsc) WHERE r < floor(n * 0.95::DOUBLE)"""),
    "attribute_score": _sql("att", "SELECT doc_id, round(att, 6) AS attribute_score FROM att"),
    "attribute_score_full": _sql("att", """SELECT doc_id,
  round(att + quality_score + (1 - toxicity_score), 6) AS attribute_score FROM att"""),
    "attribute_select": _ranked("att", "att", "att", "attribute"),
    "attribute_share": _sql("att", """SELECT doc_id, domain, round(att, 6) AS selection_score
FROM (SELECT *, row_number() OVER (ORDER BY att DESC, doc_id) - 1 AS r FROM att)
WHERE r < floor((SELECT count(*) FROM att) * 0.95::DOUBLE)"""),
    "hybrid_scores": _sql("hyb", """SELECT doc_id, round(dn, 6) AS dsir_score, round(an, 6) AS attribute_score,
  score AS selection_score FROM hyb"""),
    "hybrid_select": _SELECTED,
    "unimax_weights": _sql("grp", "SELECT domain, round(1 / count(*) OVER (), 6) AS weight FROM grp"),
    "alpha_weights": _sql("grp", f"SELECT domain, round({_ALPHA_P}, 6) AS weight FROM grp"),
    "alpha_weights_by_lang": """WITH shares AS (
  SELECT lang AS language, count(*) / (SELECT count(*) FROM documents) AS p FROM documents GROUP BY 1)
SELECT language, round(pow(p, 1.3::DOUBLE) / sum(pow(p, 1.3::DOUBLE)) OVER (), 6) AS weight FROM shares""",
    "preference_weights": _sql("grp", f"SELECT domain, round({_PREF_W}, 6) AS weight FROM grp"),
    "attribute_bucket_weights": _sql("bgrp", "SELECT bucket, round(w, 6) AS weight FROM bgrp"),
    "unimax_batch": _UNIMAX,
    "unimax_batches": _UNIMAX_BATCHES,
    "unimax_continued": _UNIMAX_BATCHES,
    "alpha_batch": _draws("grp", f"SELECT domain, n, first_id, n * {_ALPHA_P} AS mass FROM grp", "docs", "domain", _N_DRAWS),
    "alpha_batches_indexed": _draws("grp", f"SELECT domain, n, first_id, n * {_ALPHA_P} AS mass FROM grp", "docs", "domain", _N_DRAWS),
    "alpha_batch_documented": _draws("grp", f"SELECT domain, n, first_id, {_ALPHA_P} AS mass FROM grp", "docs", "domain", _N_DRAWS),
    "preference_batch": _draws("grp", f"SELECT domain, n, first_id, n * {_PREF_W} AS mass FROM grp", "docs", "domain", _N_DRAWS),
    "attribute_batch": _draws("bgrp", "SELECT bucket, n, first_id, w AS mass FROM bgrp", "bkt", "bucket", str(DRAW_SIZE)),
    "fit_passthrough": _sql("grp", f"""SELECT doc_id, domain, m AS sampling_method,
  round(CASE WHEN m = 'alpha' THEN {_ALPHA_P} ELSE 1 / (SELECT count(*) FROM grp) END, 6) AS sampling_weight
FROM docs JOIN grp USING (domain), (SELECT CASE WHEN count(*) FILTER (domain = 'code') > 0.3::DOUBLE * count(*)
  THEN 'alpha' ELSE 'unimax' END AS m FROM docs)"""),
    "train_eval_split": _sql("att", """SELECT doc_id, CASE WHEN r < floor(k * 0.8::DOUBLE) THEN 'train' ELSE 'eval' END AS split FROM (
  SELECT doc_id, row_number() OVER (ORDER BY att DESC, doc_id) - 1 AS r,
    floor(count(*) OVER () * 0.95::DOUBLE) AS k FROM att) WHERE r < k"""),
    "token_encode": _sql("docs", f"SELECT doc_id, len(t)::INTEGER AS n_tokens, md5(array_to_string(t, ',')) AS tokens_md5 FROM {_CODED}"),
    "pad_truncate": _sql("docs", f"""SELECT doc_id, len(p)::INTEGER AS length, md5(array_to_string(p, ',')) AS tokens_md5
FROM (SELECT doc_id, {_PADDED} AS p FROM {_CODED})"""),
    "training_sequences": _sql("docs", f"""SELECT doc_id, n::INTEGER AS n_tokens, {MAX_LENGTH - 1} AS length,
  md5(array_to_string(p[1:{MAX_LENGTH - 1}], ',')) AS input_md5,
  md5(array_to_string(p[2:{MAX_LENGTH}], ',')) AS labels_md5, {MAX_LENGTH - 1} AS attended
FROM (SELECT doc_id, len(t) AS n, {_PADDED} AS p FROM {_CODED})"""),
    "epoch_batches": f"""SELECT doc_id, r // 8 AS batch_id, (r % 8)::INTEGER AS place FROM (
  SELECT doc_id, row_number() OVER (ORDER BY {_uniform("'42'", str(EPOCH), 'doc_id')}, doc_id) - 1 AS r FROM documents)""",
    "epoch_order": _ORDER,
    "epoch_some_batches": f"{_ORDER} WHERE p // 8 BETWEEN {SOME_BATCHES[0]} AND {sum(SOME_BATCHES) - 1}",
    "eval_batches": """SELECT doc_id, r // 8 AS batch_id, (r % 8)::INTEGER AS place FROM (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents)""",
    "token_counts": _sql("docs", """SELECT split, domain, count(*) AS documents, sum(n)::BIGINT AS tokens FROM (
  SELECT domain, length(lower(text)) + 2 AS n, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1
    < floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'eval' END AS split FROM docs) GROUP BY 1, 2"""),
    "stream_exact_dedup": "SELECT md5(text) AS hash_id, any_value(length(text))::INTEGER AS n_chars FROM documents GROUP BY 1",
    "stream_dedup_batches": _sql("docs catalog", """SELECT doc_id, hash_id, batch FROM (
  SELECT doc_id, md5(text) AS hash_id, i AS batch, row_number() OVER (PARTITION BY md5(text) ORDER BY i, doc_id) AS r
  FROM docs JOIN catalog USING (domain)) WHERE r = 1"""),
    "stream_annotate": _sql("ann", """SELECT doc_id, quality_class, round(quality_score, 6) AS quality_score, hash_id
FROM ann WHERE nw BETWEEN 10 AND 10000"""),
}
