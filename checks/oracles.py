"""DuckDB twins of the registered queries.

They are written the other way round from the Spark code where that is
possible: tokens come from lists of pieces with ``lag``, neighbours and
first copies from window functions, Bloom bitmaps from byte sums.
"""

from __future__ import annotations

from html.entities import html5

# Patterns of the rules, written out here so that a wrong one in the library shows.
SILENT = (
    (r"(?s)<!--.*?(?:-->|\z)", ""),
    (r"(?is)<script(?:\s[^<>]*)?>.*?(?:</script\s*>|\z)", ""),
    (r"(?is)<style(?:\s[^<>]*)?>.*?(?:</style\s*>|\z)", ""),
    (r"(?is)<head(?:\s[^<>]*)?>.*?(?:</head\s*>|(<body[\s>])|\z)", r"\1"),
    (r"(?is)<noscript(?:\s[^<>]*)?>.*?(?:</noscript\s*>|\z)", ""),
    (r"(?is)<template(?:\s[^<>]*)?>.*?(?:</template\s*>|\z)", ""),
    (r"(?is)<svg(?:\s[^<>]*)?>.*?(?:</svg\s*>|\z)", ""),
)
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|br|button|caption|center|dd|details|dialog|dir|div|dl"
    "|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|legend|li|main"
    "|menu|nav|ol|option|p|pre|section|select|summary|table|tbody|td|textarea|tfoot|th|thead|tr|ul"
)
TITLE_PATTERN = r"(?is)<head>.*?<title>(.*?)</title>.*?</head>"
BLANK = r"\t\x0B\f\r\p{Z}"
CONTROL = r"\x00-\x08\x0E-\x1F\x7F-\x9F"
WORD = r"\p{L}\p{M}\p{N}"
WORD_PATTERN = r"[\p{L}\p{M}\p{N}]+(?:['’.\-][\p{L}\p{M}\p{N}]+)*"
SENTENCE_PATTERN = r"""([.!?…]["'”’)\]]*)[\t\x0B\f\r\p{Z}]+([\p{Lu}\p{N}"'“‘(\[])"""
VISIBLE_PATTERN = r"[^\t\x0B\f\r\p{Z}\n\x00-\x08\x0E-\x1F\x7F-\x9F]"
ABBREVIATIONS = "Dr|Mr|Mrs|Ms|Prof|St|vs|etc"
MEDIA_TYPE = "text/html; charset=UTF-8"
ENTITIES = {k.rstrip(";"): v for k, v in html5.items() if k.endswith(";")} | {"nbsp": " ", "shy": "", "NewLine": " "}


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


NL = "chr(10)"


# ---------------------------------------------------------------- building blocks

def paragraphs(source: str) -> str:
    """CTE ``pars(id, par_pos, par)`` over ``source`` with ``id, text``."""
    return f"""
    _cut as (select id, string_split(coalesce(text, ''), {NL}) as l from ({source})),
    _line as (select id, unnest(l) as par, generate_subscripts(l, 1) as nr from _cut),
    pars as (select id, row_number() over (partition by id order by nr) - 1 as par_pos, par
             from _line where regexp_matches(par, {lit(VISIBLE_PATTERN)}))"""


def tokens(pars: str = "pars", prefix: str = "") -> str:
    """CTE ``toks(id, par_pos, sent_pos, tok_pos, tok, glue)`` over paragraphs."""
    guard = lit(rf"(^|[^{WORD}])({ABBREVIATIONS})\.")
    piece = lit(rf"[{BLANK}]+|{WORD_PATTERN}|[^{WORD}{BLANK}]")
    p = prefix
    return f"""
    {p}_g as (select id, par_pos, regexp_replace(par, {guard}, '\\1\\2' || chr(4), 'g') as par from {pars}),
    {p}_s as (select id, par_pos, string_split(
                regexp_replace(par, {lit(SENTENCE_PATTERN)}, '\\1' || chr(1) || '\\2', 'g'), chr(1)) as l from {p}_g),
    {p}_sent as (select id, par_pos, unnest(l) as sent, generate_subscripts(l, 1) - 1 as sent_pos from {p}_s),
    {p}_p as (select id, par_pos, sent_pos,
                regexp_extract_all(replace(sent, chr(4), '.'), {piece}) as l from {p}_sent),
    {p}_piece as (select id, par_pos, sent_pos, unnest(l) as tok, generate_subscripts(l, 1) as nr from {p}_p),
    {p}_kind as (select *, regexp_matches(tok, {lit(f'^[{BLANK}]')}) as gap,
                   regexp_matches(tok, {lit(f'^[{CONTROL}]')}) as ctl from {p}_piece),
    {p}_prev as (select *, lag(gap, 1, true) over (partition by id, par_pos, sent_pos order by nr) as apart
                 from {p}_kind),
    {p}toks as (select id, par_pos, sent_pos,
               row_number() over (partition by id, par_pos, sent_pos order by nr) - 1 as tok_pos,
               tok, not apart as glue from {p}_prev where not gap and not ctl)"""


VERTICAL = f"""
    _vs as (select id, par_pos, sent_pos, '<s>' || {NL} || string_agg(
              case when glue then '<g/>' || {NL} else '' end || tok || {NL}, '' order by tok_pos)
              || '</s>' || {NL} as v from toks group by all),
    vert as (select id, par_pos, '<p>' || {NL} || string_agg(v, '' order by sent_pos) || '</p>' || {NL} as vertical
             from _vs group by id, par_pos),
    keys as (select id, par_pos, md5(vertical) as key from vert)"""

VERDICTS = """
    verdicts as (select id, par_pos, key,
      row_number() over (partition by key order by id, par_pos) > 1 as dup from keys)"""

DOCS = "select doc_id as id, text from documents"
ENGLISH = "select doc_id as id, text from documents where lang = 'en'"
ITEMS = "select item_id as id, text from benchmark"
TURNS = "select conv_id || '-' || turn as id, text from conversations"


def keys_of(source: str) -> str:
    return f"with {paragraphs(source)}, {tokens()}, {VERTICAL}"


def visible_text() -> str:
    """SQL expression over ``html``: marked text, one block per line."""
    col = f"translate(html, chr(1) || chr(2) || {NL}, '   ')"
    steps = [(pattern, lit(new)) for pattern, new in SILENT]
    steps += [
        (r"(?i)<a(?:\s[^<>]*)?>", "chr(1)"), (r"(?i)</a\s*>", "chr(2)"),
        (rf"(?i)</?(?:{BLOCK_TAGS})(?:[\s/][^<>]*)?>", NL), (r"<[/!?a-zA-Z][^<>]*>", "''"),
    ]
    for pattern, new in steps:
        col = f"regexp_replace({col}, {lit(pattern)}, {new}, 'g')"
    names = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in ENTITIES.items()) + "}"
    name = "regexp_extract(p, '^([a-zA-Z][a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);', 1)"
    code = f"""case when regexp_matches({name}, '^#0*[0-9]{{1,7}}$') then try_cast(substr({name}, 2) as bigint)
        when regexp_matches({name}, '^#[xX]0*[0-9a-fA-F]{{1,6}}$') then try_cast('0x' || substr({name}, 3) as bigint) end"""
    number = f"""case when {code} between 32 and 55295 or {code} between 57344 and 1114111 then chr(({code})::integer) end"""
    return f"""array_to_string(list_transform(string_split({col}, '&'), lambda p, i: case when i = 1 then p
        else coalesce(coalesce({names}[{name}], {number}) || substr(p, length({name}) + 2), '&' || p) end), '')"""


BLOCKS = f"""
    _m as (select page_id, {visible_text()} as t from pages),
    _l as (select page_id, string_split(t, {NL}) as l from _m),
    _b as (select page_id, unnest(l) as raw, generate_subscripts(l, 1) as nr from _l),
    -- a link that runs over several blocks: inside when opened last
    _o as (select page_id, nr, raw, coalesce(max(case when regexp_matches(raw, '[\\x01\\x02]') then nr end) over (
             partition by page_id order by nr rows between unbounded preceding and 1 preceding), 0) as src from _b),
    _i as (select o.page_id, o.nr, o.raw,
             coalesce(regexp_matches(s.raw, '\\x01[^\\x02]*$'), false) as inside
           from _o o left join _b s on s.page_id = o.page_id and s.nr = o.src),
    _t as (select page_id, nr, regexp_replace(case when inside then chr(1) else '' end || raw,
             '[ \\t\\x0B\\f\\r\\x{{00A0}}]+', ' ', 'g') as line from _i),
    _f as (select page_id, row_number() over (partition by page_id order by nr) - 1 as pos,
             trim(regexp_replace(translate(line, chr(1) || chr(2), ''), '  +', ' ', 'g')) as txt,
             len(regexp_extract_all(translate(line, chr(1) || chr(2), ''), '[^ ]+')) as nw,
             len(regexp_extract_all(array_to_string(regexp_extract_all(line, '\\x01([^\\x02]*)', 1), ' '), '[^ ]+')) as lw
           from _t where regexp_matches(line, '[^ \\x01\\x02]')),
    blocks as (select page_id, pos, txt, nw, lw / nw as ld from _f),
    _n as (select *, lag(nw, 1, 0) over w as pnw, lag(ld, 1, 0.0) over w as pld, lead(nw, 1, 0) over w as nnw
           from blocks window w as (partition by page_id order by pos)),
    classified as (select page_id, pos, txt, nw, ld, ld <= 1.0::double / 3 and
        case when pld <= 5.0::double / 9 then nw > 16 or nnw > 15 or pnw > 4 else nw > 40 or nnw > 17 end as content
        from _n),
    article as (select page_id, string_agg(txt, {NL} order by pos) as text from classified where content
                group by page_id)"""

TITLES = f"""
    titles as (select page_id, case when regexp_matches(html, {lit(TITLE_PATTERN)})
      then replace(replace(regexp_extract(html, {lit(TITLE_PATTERN)}, 1), '"', ''''), {NL}, '')
      else 'Unknown' end as title from pages)"""

HEADS = f"""
    _hp as (select page_id as id, -1 as par_pos, 0 as sent_pos, regexp_extract_all(title,
              {lit(rf"[{BLANK}]+|{WORD_PATTERN}|[^{WORD}{BLANK}]")}) as l from titles where title <> 'Unknown'),
    _hq as (select id, par_pos, sent_pos, unnest(l) as tok, generate_subscripts(l, 1) as nr from _hp),
    _hk as (select *, lag(regexp_matches(tok, {lit(f'^[{BLANK}]')}), 1, true) over (partition by id order by nr) as apart
            from _hq),
    heads as (select id, par_pos, sent_pos, row_number() over (partition by id order by nr) - 1 as tok_pos,
                tok, not apart as glue from _hk where not regexp_matches(tok, {lit(f'^[{BLANK}{CONTROL}]')}))"""


def grams(source: str) -> str:
    """CTE ``grams(id, lang, gram)`` over ``source`` with ``id, text, lang``."""
    return f"""
    _c as (select id, lang, string_split(regexp_replace(' ' || lower(coalesce(text, '')) || ' ',
             '[^\\p{{L}}\\p{{M}}]+', ' ', 'g'), '') as c from ({source})),
    grams as (select id, lang, unnest([c[i] || c[i + 1] || c[i + 2] for i in range(1, len(c) - 1)]) as gram from _c)"""


PROFILE = f"""
    _counts as (select lang, gram, count(*) as n from grams where lang is not null group by all),
    _sizes as (select lang, sum(n) + (select count(distinct gram) from _counts) as size from _counts group by lang),
    profile as (select lang, gram, round(ln((n + 1) / size), 6) as logp from _counts join _sizes using (lang)
                union all select lang, '' as gram, round(ln(1 / size), 6) as logp from _sizes)"""

# Every gram takes the unseen value, known ones then the difference to it.
PREDICT = """
    _micro as (select lang, gram, cast(round(logp * 1000000) as bigint) as micro from profile),
    _base as (select lang, micro as base from _micro where gram = ''),
    _gain as (select m.lang, m.gram, m.micro - b.base as gain from _micro m join _base b using (lang) where m.gram <> ''),
    _cnt as (select id, gram, count(*) as c from scored group by all),
    _sum as (select id, g.lang, sum(c * gain) as gain from _cnt join _gain g using (gram) group by all),
    _len as (select id, sum(c) as n from _cnt group by id),
    _score as (select l.id, b.lang, cast(l.n * b.base + coalesce(s.gain, 0) as bigint) as micro
               from _len l cross join _base b left join _sum s on s.id = l.id and s.lang = b.lang),
    best as (select id, lang, micro / 1000000 as score from _score
             qualify row_number() over (partition by id order by micro desc, lang) = 1)"""


def bloom(keys: str, name: str, n: str | None = None) -> str:
    """CTEs ``{name}_spec`` and ``{name}_bits(bucket, bit)`` of a key table."""
    n = n or f"(select greatest(1, count(distinct key)) from {keys})"
    p = "0.01::double"
    tries = ", ".join(str(k) for k in range(1, 33))
    return f"""
    {name}_n as (select {n} as n),
    {name}_t as (select n, k, -k * n / ln(1 - pow({p}, 1.0::double / k)) as m
                 from {name}_n, (select unnest([{tries}]) as k)),
    {name}_spec as (select k, greatest(1, floor(m))::bigint as m, n from {name}_t
                    where m <= 1.2 * (select min(m) from {name}_t) order by k limit 1),
    {name}_dim as (select k, m, n, (m + 32767) // 32768 as blocks,
                     (m + (m + 32767) // 32768 - 1) // ((m + 32767) // 32768) as width from {name}_spec)"""


def bits_of(keys: str, name: str) -> str:
    """``key, bucket, bit`` for every bit a key sets in filter ``name``."""
    h = [f"cast('0x' || substr(key, {a}, {n}) as bigint)" for a, n in ((1, 15), (16, 8), (24, 8))]
    return f"""select key, {h[0]} % d.blocks as bucket, ({h[1]} + i.i * {h[2]}) % d.width as bit
        from (select distinct key from {keys}), {name}_dim d, (select unnest(range(0, 8)) as i) i where i.i < d.k"""


def bitmaps(bits: str) -> str:
    """CTE ``maps(bucket, bitmap)`` with the bitmap as hexadecimal text."""
    return f"""
    _byte as (select bucket, bit // 8 as byte, sum(1 << (bit % 8)) as v
              from (select distinct bucket, bit::integer as bit from {bits}) group by all),
    _grid as (select bucket, unnest(range(0, 4096)) as byte from (select distinct bucket from _byte)),
    maps as (select bucket, string_agg(printf('%02x', coalesce(v, 0)::bigint), '' order by byte) as bitmap
             from _grid left join _byte using (bucket, byte) group by bucket)"""


LEXICON = f"""
    _tag as (select tok as form, case when regexp_matches(tok, '^\\p{{N}}') then 'NUM'
        when not regexp_matches(tok, '[\\p{{L}}\\p{{N}}]') then 'PUNCT' when tok like '%ing' then 'VBG'
        when tok like '%ed' then 'VBD' when tok like '%ly' then 'RB' when regexp_matches(tok, '^\\p{{Lu}}') then 'NNP'
        else 'NN' end as pos, lower(tok) as lemma from lextoks),
    _reading as (select form, pos, lemma, count(*) as n from _tag group by all),
    lexicon as (select form, pos, lemma from _reading
                qualify row_number() over (partition by form order by n desc, pos, lemma) = 1),
    _end as (select pos, right(lower(form), i) as suffix
             from lexicon, (select unnest([1, 2, 3, 4]) as i) where length(lower(form)) > i),
    _ends as (select suffix, pos, count(*) as n from _end group by all),
    suffixes as (select suffix, pos from _ends
                 qualify row_number() over (partition by suffix order by n desc, pos) = 1)"""

LEX_TOKENS = f"""{paragraphs(TURNS).replace('_cut', '_lcut').replace('_line', '_lline').replace('pars', 'lexpars')},
    {tokens('lexpars', 'lex')}"""


def annotated(toks: str) -> str:
    """CTE ``ann``: ``toks`` with ``pos, lemma``."""
    ends = " ".join(
        f"left join suffixes s{n} on length(lower(t.tok)) > {n} and s{n}.suffix = right(lower(t.tok), {n})"
        for n in (4, 3, 2, 1)
    )
    return f"""
    ann as (select t.*, coalesce(e.pos, l.pos, s4.pos, s3.pos, s2.pos, s1.pos, 'UNK') as pos,
              coalesce(e.lemma, l.lemma, t.tok) as lemma
            from {toks} t left join lexicon e on e.form = t.tok left join lexicon l on l.form = lower(t.tok) {ends})"""


PAGE_TOKENS = f"""
    {BLOCKS}, {TITLES},
    {paragraphs('select page_id as id, text from article')}, {tokens()}, {HEADS},
    _doc as (select a.page_id as id, '<doc id="' || a.page_id || '" uri="' || p.url || '" title="' ||
               regexp_replace(t.title, '[\\t\\r\\n]+', ' ', 'g') || '">' as open
             from article a join pages p using (page_id) join titles t using (page_id)),
    _all as (select * from toks union all select h.* from heads h where h.id in (select id from _doc)),
    _edge as (select *,
        lag(par_pos) over d as p0, lead(par_pos) over d as p1, lag(sent_pos) over d as s0, lead(sent_pos) over d as s1
        from _all window d as (partition by id order by par_pos, sent_pos, tok_pos)),
    markup as (select e.id, par_pos, sent_pos, tok_pos, tok, glue,
        case when p0 is null then open else '' end || case
          when par_pos = -1 then case when tok_pos = 0 then '<head>' else '' end
          when p0 is distinct from par_pos then '<p><s>' when s0 <> sent_pos then '<s>' else '' end as before,
        case when par_pos = -1 then case when p1 is distinct from -1 then '</head>' else '' end
          when p1 is distinct from par_pos then '</s></p>' when s1 <> sent_pos then '</s>' else '' end
          || case when p1 is null then '</doc>' else '' end as after
        from _edge e join _doc d on d.id = e.id)"""

ANNOTATED_PAGES = f"{PAGE_TOKENS}, {LEX_TOKENS}, {LEXICON}, {annotated('markup')}"

LINES = f"""
    _ln as (select id, par_pos, sent_pos, tok_pos, 0 as extra, lemma || chr(9) || tok || chr(9) ||
              case when before = '' and after = '' then '_' || chr(9) || '_' else before || chr(9) || after end
              || chr(9) || pos as line from ann
            union all select id, par_pos, sent_pos, tok_pos, 1, '' from ann
              where contains(after, '</s>') or contains(after, '</head>')),
    lines as (select id, row_number() over (partition by id order by par_pos, sent_pos, tok_pos, extra) - 1
                as line_pos, line from _ln)"""

EVENTS = """
    prof as (select 'run-' || (event_id % 2) as deployment_id, event_type as bolt_type, cast(event_id // 10 as varchar) as tuple_uuid, 1 as num_elements,
      cast(user_id as varchar) as hostname, ts as timestamp, cast(round(value * 1000000) as bigint) as time from events)"""
SUMMARY = "count(*) as n, sum(time)::bigint as total, round(avg(time), 3) as avg, max(time) as max"

KEPT = f"""
    kept as (select p.id, string_agg(p.par, {NL} order by p.par_pos) filter (not v.dup) as text,
               count(*) as n_par, count(*) filter (v.dup) as n_dup
             from pars p join verdicts v on v.id = p.id and v.par_pos = p.par_pos group by p.id)"""


def reassembled(source: str) -> str:
    return f"""{keys_of(source)}, {VERDICTS}, {KEPT}
      select d.id as doc_id, coalesce(k.text, '') as text, coalesce(k.n_par, 0) as n_par, coalesce(k.n_dup, 0) as n_dup
      from ({source}) d left join kept k on k.id = d.id"""


CONLL = """
    rows as (select id, par_pos, sent_pos, tok_pos,
      concat_ws(chr(9), tok_pos + 1, tok, lemma, pos, pos, '_', '_', '_', '_', '_') as line from ann where par_pos >= 0)"""

ALL_VERDICTS = f"{keys_of(DOCS)}, {VERDICTS}"
EARLIER = f"""
    {keys_of(DOCS)}, {VERDICTS},
    {paragraphs(ITEMS).replace('_cut', '_bcut').replace('_line', '_bline').replace('pars', 'bpars')},
    {tokens('bpars', 'b')},
    {VERTICAL.replace('_vs', '_bvs').replace('toks', 'btoks').replace('vert ', 'bvert ').replace('from vert', 'from bvert').replace('keys as', 'bkeys as')}"""
BENCH_BLOOM = f"""{EARLIER},
    {bloom('bkeys', 'f')}, fbits as (select distinct bucket, bit from ({bits_of('bkeys', 'f')})),
    probe as (select key, bool_and(f.bit is not null) as maybe_seen
              from ({bits_of('keys', 'f')}) b left join fbits f on f.bucket = b.bucket and f.bit = b.bit group by key)"""
ALL_GRAMS = grams("select doc_id as id, text, lang from documents")

CLEAN = f"""
    {BLOCKS}, {TITLES}, {ALL_GRAMS}, {PROFILE},
    {grams("select page_id as id, text, null as lang from article").replace('_c as', '_ac as').replace('from _c', 'from _ac').replace('grams as', 'agrams as')},
    scored as (select id, gram from agrams), {PREDICT},
    docs as (select a.page_id as id, a.text from article a join best b on b.id = a.page_id where b.lang = 'en'),
    {paragraphs('select * from docs')}, {tokens()}, {VERTICAL}, {VERDICTS}, {KEPT},
    clean as (select d.id as page_id, coalesce(k.text, '') as text from docs d left join kept k on k.id = d.id)"""
# The kept text is cut into tokens again, under names of their own.
AGAIN = f"""{paragraphs('select page_id as id, text from clean').replace('_cut', '_xcut').replace('_line', '_xline').replace('pars', 'xpars')},
    {tokens('xpars', 'x')}"""
MARKED = PAGE_TOKENS[PAGE_TOKENS.index("_hp as"):].replace("from article a", "from clean a").replace("from toks union", "from xtoks union")
CLEAN_ANNOTATED = f"{CLEAN}, {AGAIN}, {MARKED}, {LEX_TOKENS}, {LEXICON}, {annotated('markup')}"

ORACLES: dict[str, str] = {
    "corpus_vertical": f"""with {CLEAN_ANNOTATED}, {LINES} select id as doc_id,
        string_agg(line || {NL}, '' order by line_pos) as vertical from lines group by id""",
    "stream_corpus": f"""with {CLEAN_ANNOTATED}, {LINES},
        _w as (select line from lines union all select '' from (select distinct id from lines))
        select line, count(*) as n from _w group by line""",
    "corpus_conll": f"""with {CLEAN_ANNOTATED}, {CONLL},
        _sn as (select id, par_pos, sent_pos, string_agg(line || {NL}, '' order by tok_pos) || {NL} as s
                from rows group by all)
        select id as doc_id, string_agg(s, '' order by par_pos, sent_pos) as conll from _sn group by id""",
    "src_warc": f"""select 'page-' || page_id as doc_id, url as uri, {lit(MEDIA_TYPE)} as content_type,
        regexp_replace(html, '\\r\\n?', {NL}, 'g') as payload, 'ok' as framing from pages""",
    "src_warc_manifest": f"""select 'doc-' || doc_id as doc_id, 'urn:doc:' || doc_id as uri, 'unknown' as content_type,
        regexp_replace('first' || {NL} || {NL} || 'WARC/1.0' || {NL} || 'Content-Length: 3' || {NL} || {NL} || coalesce(text, ''),
          '\\r\\n?', {NL}, 'g') as payload, 'ok' as framing from documents""",
    "filter_html": """select * from (
        select 'p' || page_id as rec_id, cast(null as varchar) as content_type, html as payload from pages
        union all select 'd' || doc_id, 'text/plain', text from documents)
        where length(payload) > 0 and (starts_with(payload, '<!DOCTYPE html')
          or contains(coalesce(content_type, 'unknown'), 'text/html'))""",
    "extract_title": f"with {TITLES} select page_id, url, title from pages join titles using (page_id)",
    "html_blocks": f"with {BLOCKS} select * from blocks",
    "block_classify": f"with {BLOCKS} select * from classified",
    "article_text": f"with {BLOCKS} select * from article where text <> ''",
    "langid_fit": f"with {ALL_GRAMS}, {PROFILE} select * from profile",
    "langid_predict": f"""with {ALL_GRAMS}, {PROFILE}, scored as (select id, gram from grams), {PREDICT}
        select d.doc_id, b.lang, b.score from documents d left join best b on b.id = d.doc_id""",
    "filter_lang": "select doc_id, text, lang, source from documents where lang = 'en'",
    "paragraph_split": f"with {paragraphs(DOCS)} select id as doc_id, par_pos, par from pars",
    "token_table": f"""with {paragraphs(DOCS)}, {tokens()}
        select id as doc_id, par_pos, sent_pos, tok_pos, tok, glue from toks""",
    "head_tokens": f"with {TITLES}, {HEADS} select id as page_id, tok_pos, tok, glue from heads",
    "vertical_paragraph": f"{keys_of(DOCS)} select id as doc_id, par_pos, vertical from vert",
    "paragraph_hash": f"{keys_of(DOCS)} select id as doc_id, par_pos, key from keys",
    "dedup_first_seen": f"{ALL_VERDICTS} select id as doc_id, par_pos, key, dup from verdicts",
    "dedup_keep_unique": f"""{ALL_VERDICTS} select v.id as doc_id, v.par_pos, t.vertical as par
        from verdicts v join vert t on t.id = v.id and t.par_pos = v.par_pos where not v.dup""",
    "dedup_against_earlier": f"""{EARLIER} select id as doc_id, par_pos, key,
          dup or key in (select key from bkeys) as dup from verdicts""",
    "dup_stats": f"""{ALL_VERDICTS} select id as doc_id, count(*) as n_par, count(*) filter (dup) as n_dup
        from verdicts group by id""",
    "doc_verdict_join": f"""{ALL_VERDICTS},
        _a as (select id, count(*) as n from pars group by id), _v as (select id, count(*) as n from verdicts group by id)
        select doc_id, coalesce(a.n, 0) as n_par, coalesce(v.n, 0) as n_verdict,
          coalesce(a.n, 0) = coalesce(v.n, 0) as complete
        from documents left join _a a on a.id = doc_id left join _v v on v.id = doc_id""",
    "reassemble": reassembled(ENGLISH),
    "clean_corpus": f"""with {BLOCKS}, {TITLES}, {ALL_GRAMS}, {PROFILE},
        {grams("select page_id as id, text, null as lang from article").replace('_c as', '_ac as').replace('from _c', 'from _ac').replace('grams as', 'agrams as')},
        scored as (select id, gram from agrams), {PREDICT},
        docs as (select a.page_id as id, a.text from article a join best b on b.id = a.page_id where b.lang = 'en'),
        {paragraphs('select * from docs')}, {tokens()}, {VERTICAL}, {VERDICTS}, {KEPT}
        select d.id as doc_id, p.url as uri, t.title, coalesce(k.text, '') as text, coalesce(k.n_par, 0) as n_par,
          coalesce(k.n_dup, 0) as n_dup
        from docs d join pages p on p.page_id = d.id join titles t on t.page_id = d.id left join kept k on k.id = d.id""",
    "bloom_build": f"""{keys_of(DOCS)}, {bloom('keys', 'f')}, fb as ({bits_of('keys', 'f')}), {bitmaps('fb')}
        select bucket, bitmap, k, m, n from maps, f_dim""",
    "bloom_probe": f"""{BENCH_BLOOM} select k.id as doc_id, k.par_pos, k.key, p.maybe_seen
        from keys k join probe p on p.key = k.key""",
    "bloom_merge": f"""{keys_of(f"{DOCS} union all select 1000000000000 + conv_id * 1000 + turn as id, text from conversations")},
        {bloom('keys', 'f')}, fb as ({bits_of('keys', 'f')}), {bitmaps('fb')}
        select bucket, bitmap, k, m, (select round(-any_value(m)::double / any_value(k) *
            ln(greatest(any_value(m) - count(*), 1) / any_value(m)))::bigint
            from (select distinct bucket, bit from fb), f_dim) as n from maps, f_dim""",
    "bloom_stats": f"""{keys_of(DOCS)}, {bloom('keys', 'f')}, fb as ({bits_of('keys', 'f')})
        select any_value(k) as k, any_value(m) as m, any_value(n) as n, count(*) as bits_set,
          round(-any_value(m)::double / any_value(k) * ln(greatest(any_value(m) - count(*), 1) / any_value(m)))::bigint as n_est,
          round(pow(least(count(*) / any_value(m), 1), any_value(k)), 9) as fpp
        from (select distinct bucket, bit from fb), f_dim""",
    "dedup_bloom": f"""{BENCH_BLOOM} select v.id as doc_id, v.par_pos, v.key, v.dup or p.maybe_seen as dup
        from verdicts v join probe p on p.key = v.key""",
    "lexicon_fit": f"with {LEX_TOKENS}, {LEXICON} select * from lexicon",
    "annotate_tokens": f"""with {paragraphs(DOCS)}, {tokens()}, {LEX_TOKENS}, {LEXICON}, {annotated('toks')}
        select id as doc_id, par_pos, sent_pos, tok_pos, tok, glue, pos, lemma from ann""",
    "annotate_hook": f"""with {paragraphs(DOCS)}, {tokens()} select id as doc_id, par_pos, sent_pos, tok_pos,
        length(tok) as n_chars, regexp_matches(tok, '^[0-9]') as numeric from toks""",
    "token_markup": f"""with {PAGE_TOKENS} select id as doc_id, par_pos, sent_pos, tok_pos, tok, glue, before, after
        from markup""",
    "vertical_lines": f"with {ANNOTATED_PAGES}, {LINES} select id as doc_id, line_pos, line from lines",
    "vertical_document": f"""with {ANNOTATED_PAGES}, {LINES} select id as doc_id,
        string_agg(line || {NL}, '' order by line_pos) as vertical from lines group by id""",
    "conll_rows": f"with {ANNOTATED_PAGES}, {CONLL} select id as doc_id, par_pos, sent_pos, tok_pos, line from rows",
    "conll_document": f"""with {ANNOTATED_PAGES}, {CONLL},
        _sn as (select id, par_pos, sent_pos, string_agg(line || {NL}, '' order by tok_pos) || {NL} as s
                from rows group by all)
        select id as doc_id, string_agg(s, '' order by par_pos, sent_pos) as conll from _sn group by id""",
    "sink_conll": f"""with {ANNOTATED_PAGES}, {CONLL},
        _w as (select line from rows union all select '' from (select distinct id, par_pos, sent_pos from rows)
               union all select '' from (select distinct id from rows))
        select line, count(*) as n from _w group by line""",
    "sink_vertical": f"""with {ANNOTATED_PAGES}, {LINES},
        _w as (select line from lines union all select '' from (select distinct id from lines))
        select line, count(*) as n from _w group by line""",
    "stage_counts": f"""with f as (select true as a, regexp_matches(coalesce(text, ''), {lit(VISIBLE_PATTERN)}) as b,
          lang = 'en' as c, source = 'web' as d from documents),
        t as (select count(*) as n0, count(*) filter (b) as n1, count(*) filter (b and c) as n2,
          count(*) filter (b and c and d) as n3 from f)
        select 'read' as stage, n0 as n, cast(null as double) as selectivity from t
        union all select 'text', n1, round(n1 / nullif(n0, 0), 9) from t
        union all select 'english', n2, round(n2 / nullif(n1, 0), 9) from t
        union all select 'labelled', n3, round(n3 / nullif(n2, 0), 9) from t""",
    "profile_rows": f"""with {paragraphs(ENGLISH)}
        select 'check' as deployment_id, bolt_type, 'all' as tuple_uuid, num_elements from (
          select 'read' as bolt_type, count(*) as num_elements from documents
          union all select 'language', count(*) from ({ENGLISH})
          union all select 'paragraphs', count(*) from pars)""",
    "profile_by_stage": f"""with {EVENTS} select deployment_id, bolt_type, sum(num_elements)::bigint as elements, {SUMMARY}
        from prof group by all""",
    "profile_by_host": f"with {EVENTS} select deployment_id, hostname, bolt_type, {SUMMARY} from prof group by all",
    "profile_by_time": f"""with {EVENTS} select date_trunc('hour', timestamp) as bucket, deployment_id, bolt_type, {SUMMARY}
        from prof group by all""",
    "profile_trace": f"""with {EVENTS} select deployment_id, tuple_uuid, min(timestamp) as first_seen, max(timestamp) as last_seen,
        {SUMMARY} from prof group by all""",
    "stream_first_seen": f"{keys_of(DOCS)} select distinct key from keys",
    "stream_dedup": f"{ALL_VERDICTS} select id as doc_id, par_pos, key, dup from verdicts",
    "stream_documents": reassembled(DOCS),
}
