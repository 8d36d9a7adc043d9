"""Secret scan with DataFrame functions only: three patterns and a battery of randomness tests.

Patterns. `assign` (a password-like word, a sign, a value), `access` (access key ids) and
`hex` (long lower-case hexadecimal runs) are found with split and regexp_extract_all: the
lengths of the pieces between matches give places in code points.

Battery. Runs of 20 or more characters that can hold encoded data are candidates if their
characters mix classes as an encoding does; the encoding is the smallest alphabet that fits
(hexadecimal, base 32, base 36, base 62, base 64, URL-safe base 64). A candidate that fits
none (a token behind a prefix or in a path) is taken apart, and what fits is tested:

* its runs of 20 or more characters without '/' and '+', without '-' and '_', and without all four;
* UUIDs, and runs without '/' and '+' whose groups between '-' and '_' are all shorter than 20
  characters, by their characters without those signs. (Groups between slashes are not put together.)

A span of the method within another one is not reported. Random text of the
alphabet is the hypothesis of three tests:

* chi-squared of character counts against the uniform alphabet, with the exact mean and
  variance of the statistic for the length;
* runs above and below the middle of the alphabet (Wald-Wolfowitz);
* serial correlation of neighbouring characters' ranks.

Their p-values are combined by three times the smallest; a random token has a large one.

Control. What is reported has a bounded expected share of ordinary text. How ordinary text
scores is learnt from the corpus: each document gives a decoy for every alphabet, of the
length class and from the place that its hash picks: prose there, without candidates and
without characters outside the alphabet, run together. Under that null of its alphabet and
length class a candidate has the p-value (1 + decoys that look as random) / (1 + decoys);
within each length class the Benjamini-Hochberg procedure at FALSE_DISCOVERY picks what is
reported, as spans of the kind `random`, if its p is LEAST_P or more. All is counted on a fixed grid of p (GRID steps a
decade), so the corpus is summed up in a table of bounded size. A null of fewer than LEAST_NULL
decoys takes in those of the next shorter length class, and so on: shorter prose looks more random,
so p-values only grow. The rule is the same at every size: a corpus with few decoys has large p-values and
reports little beyond the patterns, one without any nothing. `limits` of a larger corpus (thresholds)
may be given instead. Spans of the method that touch a pattern's span are left out.

The texts are scanned once: spans, p-values and decoys are written, what is reported is chosen from them.

Null text: empty, no spans. Empty table: no rows. Every row is scanned by itself; only the table of p-values
looks at all rows. A column with the name of the new one is replaced. Matches of a text are
gathered CHUNK by CHUNK, so a text with very many of them takes no square of their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.llm import store

FALSE_DISCOVERY = 0.05
LEAST_NULL = 100
LEAST_P = 0.002  # below it a token isn't random at all, however much worse ordinary text does
GRID = 20
CHUNK = 256
_DECADES = 12
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_PATTERNS = {"assign": _ASSIGN, "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
_CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Parts of a candidate that fits no encoding as a whole.
_SEGMENT = r"[A-Za-z0-9_-]{20,}={0,2}"
_PARTS = (_SEGMENT, r"[A-Za-z0-9+/]{20,}={0,2}", r"[A-Za-z0-9]{20,}={0,2}")
_UUID = r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])"

# Alphabets in the order of their digits.
_HEX = "0123456789abcdef"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_URL64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
#: Alphabet, what a token of it looks like (all of its classes occur), and the null it is compared with.
_ENCODINGS = (
    (_HEX, "^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", 0),
    (_HEX.upper(), "^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", 0),
    (_BASE32, "^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", 1),
    (_BASE36.upper(), "^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", 2),
    (_BASE36, "^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", 2),
    (_BASE62, "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", 3),
    (_BASE64, "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$", 4),
    (_URL64, "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$", 5),
)
#: Alphabet of each null and the function that brings prose into its case.
_NULLS = ((_HEX, "lower"), (_BASE32, "upper"), (_BASE36, "lower"), (_BASE62, ""), (_BASE64, ""), (_URL64, ""))
#: Length classes of the false-discovery control.
_LENGTHS = (20, 32, 48, 64, 128)


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SPAN = "struct<start:int,stop:int,kind:int,match:string>"


def _spans(text: str, pattern: str, kind: str, keep: str = "true") -> str:
    """SQL: all matches of a pattern as (start, stop, kind number, match), leftmost first."""
    p = _quote(pattern)
    match = f"named_struct('start', s.at + length(x.`0`), 'stop', s.at + length(x.`0`) + length(x.`1`), 'kind', {KINDS.index(kind)}, 'match', x.`1`)"
    found = f"""
      aggregate(
        arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0)),
        named_struct('at', 0, 'chunk', cast(array() as array<{_SPAN}>), 'done', cast(array() as array<array<{_SPAN}>>)),
        (s, x) -> CASE
          WHEN x.`1` is null THEN s
          WHEN size(s.chunk) < {CHUNK} THEN named_struct('at', s.at + length(x.`0`) + length(x.`1`), 'chunk', array_append(s.chunk, {match}), 'done', s.done)
          ELSE named_struct('at', s.at + length(x.`0`) + length(x.`1`), 'chunk', array({match}), 'done', array_append(s.done, s.chunk)) END,
        s -> filter(flatten(array_append(s.done, s.chunk)), m -> {keep}))"""
    return f"if(regexp_like({text}, {p}), {found}, cast(array() as array<{_SPAN}>))"


def _tail(z: str) -> str:
    """SQL: two-sided tail of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    poly = f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))"
    return f"least(1D, greatest(0D, 2 * 0.3989422804014327 * exp(-({z}) * ({z}) / 2) * {poly}))"


def _let(body: str, expr: str, var: str) -> str:
    """SQL: body, with var for the value of expr."""
    return f"element_at(transform(array({expr}), {var} -> {body}), 1)"


def _battery(token: str, alphabet: str) -> str:
    """SQL: the combined p-value of a token (without padding) of two or more characters under an alphabet."""
    ranks = f"transform(filter(split({token}, ''), c -> c <> ''), c -> instr({alphabet}, c) - 1)"
    n, k = "cast(size(v.r) as double)", f"cast(length({alphabet}) as double)"
    # the sum of squared counts from one walk over the sorted ranks: a run's c-th member adds 2 c - 1
    squares = "aggregate(sort_array(v.r), named_struct('p', -1, 'c', 0, 's', 0D), (a, x) -> named_struct('p', x, 'c', if(x = a.p, a.c + 1, 1), 's', a.s + if(x = a.p, 2 * a.c + 1, 1)), a -> a.s)"
    chi = f"({k} / {n} * {squares} - {n})"
    z_chi = f"(({chi} - ({k} - 1)) / sqrt(2 * ({k} - 1) * ({n} - 1) / {n}))"
    high = f"cast(size(filter(v.r, x -> 2 * x >= {k})) as double)"
    runs = f"(1 + size(filter(sequence(1, size(v.r) - 1), i -> (2 * v.r[i] >= {k}) <> (2 * v.r[i - 1] >= {k}))))"
    mean_runs = f"(1 + 2 * g.h * ({n} - g.h) / {n})"
    z_runs = f"if(g.h in (0, {n}), 9D, ({runs} - {mean_runs}) / sqrt(greatest(1e-9, ({mean_runs} - 1) * ({mean_runs} - 2) / ({n} - 1))))"
    mean = f"(aggregate(v.r, 0D, (s, x) -> s + x) / {n})"
    cov = "aggregate(sequence(1, size(v.r) - 1), 0D, (s, i) -> s + (v.r[i] - w) * (v.r[i - 1] - w))"
    var = "aggregate(v.r, 0D, (s, x) -> s + (x - w) * (x - w))"
    z_serial = _let(f"if({var} = 0, 9D, sqrt({n}) * {cov} / {var} + 1 / sqrt({n}))", mean, "w")
    # too even a count is no sign of ordinary text, so chi-squared is one-sided
    p_chi = _let(f"if(z > 0, {_tail('z')} / 2, 1D - {_tail('z')} / 2)", z_chi, "z")
    p_runs = _let(_tail("z"), _let(z_runs, f"named_struct('h', {high})", "g"), "z")
    p_serial = _let(_tail("z"), z_serial, "z")
    return _let(f"least(1D, 3 * least({p_chi}, {p_runs}, {p_serial}))", f"named_struct('r', {ranks})", "v")


def _with_p(token: str) -> str:
    """SQL: struct of the battery's combined p-value and the number of the null, for the encoding that fits the token; null if none does."""
    bare = f"trim(TRAILING '=' FROM {token})"
    fit = "CASE " + " ".join(f"WHEN {bare} rlike {_quote(p)} THEN named_struct('a', {_quote(a)}, 'null_no', {n})" for a, p, n in _ENCODINGS) + " END"
    return _let(f"if(e is null or length({bare}) < 2, cast(null as struct<p:double,null_no:int>), named_struct('p', {_battery(bare, 'e.a')}, 'null_no', e.null_no))", fit, "e")


def _fits(token: str) -> str:
    """SQL: whether an encoding fits the token."""
    return f"(trim(TRAILING '=' FROM {token}) rlike {_quote('|'.join(p for _, p, _ in _ENCODINGS))})"


def _pieces(candidates: str) -> str:
    """SQL: what is tested of the candidates: (start, stop, kind, match, token), the token being the match without what groups it."""
    row = lambda token: f"transform(@, m -> named_struct('start', c.start + m.start, 'stop', c.start + m.stop, 'kind', m.kind, 'match', m.match, 'token', {token}))"
    bare = "regexp_replace(m.match, '[-_]', '')"
    parts = ", ".join(row("m.match").replace("@", _spans("c.match", p, "random")) for p in _PARTS)
    grouped = f"not {_fits('m.match')} and not m.match rlike '[A-Za-z0-9]{{20}}' and length(trim(TRAILING '=' FROM {bare})) >= 20"
    groups = ", ".join(row(bare).replace("@", _spans("c.match", p, "random", keep)) for p, keep in ((_UUID, "true"), (_SEGMENT, grouped)))
    whole = "array(named_struct('start', c.start, 'stop', c.stop, 'kind', c.kind, 'match', c.match, 'token', c.match))"
    return f"flatten(transform({candidates}, c -> if({_fits('c.match')}, {whole}, filter(array_distinct(concat({parts}, {groups})), q -> {_fits('q.token')}))))"


def _length_class(n: str) -> str:
    return "CASE " + " ".join(f"WHEN {n} >= {k} THEN {i}" for i, k in reversed(list(enumerate(_LENGTHS)))) + " ELSE -1 END"


def _found(docs: DataFrame, text: str, name: str) -> DataFrame:
    """docs with a column of pattern spans and tested candidates (p: their combined p-value, null_no) that touch none of them."""
    t = f"`{text}`"
    strong = f"length(regexp_extract(m.match, {_quote(_ASSIGN)}, 2)) >= 8"
    base = f"array_sort(concat({_spans(t, _ASSIGN, 'assign', strong)}, {_spans(t, _PATTERNS['access'], 'access')}, {_spans(t, _PATTERNS['hex'], 'hex')}))"
    docs = docs.withColumn(f"{name}_base", F.coalesce(F.expr(base), F.expr(f"cast(array() as array<{_SPAN}>)")))
    free = f"filter({_pieces(_spans(t, _CANDIDATE, 'random'))}, m -> not exists({name}_base, b -> b.start < m.stop and m.start < b.stop))"
    tested = f"filter(transform({free}, m -> named_struct('start', m.start, 'stop', m.stop, 'kind', m.kind, 'match', m.match, 't', {_with_p('m.token')})), m -> m.t is not null)"
    return docs.withColumn(f"{name}_tested", F.coalesce(F.expr(tested), F.expr("cast(array() as array<struct<start:int,stop:int,kind:int,match:string,t:struct<p:double,null_no:int>>>)")))


def _decoys(text: str) -> str:
    """SQL: (null_no, length, p) of the decoys of one text, one for each null for which its prose is long enough."""
    out = []
    for i, (alphabet, case) in enumerate(_NULLS):
        outside = _quote("[^" + alphabet.replace("-", "\\-") + "]")
        size = f"element_at(array({', '.join(map(str, _LENGTHS))}), cast(1 + pmod(xxhash64({text}, {i}), {len(_LENGTHS)}) as int))"
        place = f"cast(1 + pmod(xxhash64({i}, {text}), greatest(1, length({text}) - 24 * d.n + 1)) as int)"
        prose = f"regexp_replace(regexp_replace(substring({text}, {place}, 24 * d.n), {_quote('^' + chr(92) + 'S+|' + chr(92) + 'S+$')}, ''), {_quote(_CANDIDATE)}, '')"
        token = f"substring(regexp_replace({case}({prose}), {outside}, ''), 1, d.n)"
        row = f"named_struct('null_no', {i}, 'length', d.n, 'p', if(length(d.t) = d.n, {_battery('d.t', _quote(alphabet))}, cast(null as double)))"
        out.append(_let(_let(row, f"named_struct('n', d.n, 't', {token})", "d"), f"named_struct('n', {size})", "d"))
    return f"filter(array({', '.join(out)}), d -> d.p is not null)"


def _step(p: str) -> str:
    return f"least({GRID * _DECADES}, cast(floor(-{GRID} * log10(greatest({p}, 1e-{_DECADES}))) as int))"


def _scored(docs: DataFrame, text: str, name: str) -> DataFrame:
    """_found with the decoys of each text."""
    none = "cast(array() as array<struct<null_no:int,length:int,p:double>>)"
    return _found(docs, text, name).withColumn(f"{name}_decoys", F.expr(f"coalesce({_decoys(f'`{text}`')}, {none})"))


def thresholds(docs: DataFrame, text: str = "text", false_discovery: float = FALSE_DISCOVERY) -> dict[tuple[int, int], int]:
    """For each length class and null the last step of the grid that is reported, over all of docs (-1: none)."""
    return _thresholds(_scored(docs.select(text), text, "__s"), "__s", false_discovery)


def _thresholds(scored: DataFrame, name: str, false_discovery: float) -> dict[tuple[int, int], int]:
    tested = f"transform({name}_tested, m -> named_struct('decoy', false, 'null_no', m.t.null_no, 'length_class', {_length_class('m.stop - m.start')}, 'step', {_step('m.t.p')}))"
    decoys = f"transform({name}_decoys, d -> named_struct('decoy', true, 'null_no', d.null_no, 'length_class', {_length_class('d.length')}, 'step', {_step('d.p')}))"
    table = scored.selectExpr(f"inline(concat({tested}, {decoys}))").groupBy("decoy", "null_no", "length_class", "step").count().collect()  # at most 2 x 6 x 5 x 241 rows
    counts = {(r[0], r[1], r[2], r[3]): r[4] for r in table}
    steps = range(GRID * _DECADES + 1)

    def null_of(i: int, c: int) -> list[int]:
        total = [0] * len(steps)
        for k in range(c, -1, -1):
            total = [n + counts.get((True, i, k, step), 0) for step, n in zip(steps, total, strict=True)]
            if sum(total) >= LEAST_NULL:
                break
        return total

    out = {}
    for c in range(len(_LENGTHS)):
        rows = []  # (p-value under the null, candidates, null, step)
        for i in range(len(_NULLS)):
            null = null_of(i, c)
            own = [counts.get((False, i, c, k), 0) for k in steps]
            out[c, i], seen = -1, 0
            for k, n in enumerate(own):  # small steps hold large p-values of the battery
                seen += null[k]
                if n and 10 ** (-k / GRID) >= LEAST_P:
                    rows.append(((1 + seen) / (1 + sum(null)), n, i, k))
        total = sum(n for (decoy, _, own_class, _), n in counts.items() if not decoy and own_class == c)
        below, level = 0, -1.0
        for q, n, _, _ in sorted(rows):
            below += n
            if q * total <= false_discovery * below:
                level = q
        for q, _, i, k in rows:
            if q <= level:
                out[c, i] = max(out[c, i], k)
    return out


def _chosen(docs: DataFrame, text: str, name: str, false_discovery: float, limits: dict | None, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs and `name`, the spans that are reported."""
    scored = _scored(docs, text, name).select(*(F.col(f"`{c}`") for c in keep), f"{name}_base", f"{name}_tested", f"{name}_decoys")
    scored = store.cut(scored, "secrets")
    limit = {k: v for k, v in (_thresholds(scored, name, false_discovery) if limits is None else limits).items() if v >= 0}
    at = "CASE " + " ".join(f"WHEN {_length_class('m.stop - m.start')} = {c} AND m.t.null_no = {i} THEN {v}" for (c, i), v in sorted(limit.items())) + " ELSE -1 END" if limit else "-1"
    kept = f"filter({name}_tested, m -> {_step('m.t.p')} <= {at})"
    outer = f"element_at(transform(array({kept}), k -> filter(k, m -> not exists(k, o -> o.start <= m.start and o.stop >= m.stop and o.stop - o.start > m.stop - m.start))), 1)"
    random = f"transform({outer}, m -> named_struct('start', m.start, 'stop', m.stop, 'kind', m.kind, 'match', m.match))"
    spans = F.expr(f"array_sort(concat({name}_base, {random}), (a, b) -> CASE WHEN a.start <> b.start THEN a.start - b.start ELSE a.kind - b.kind END)")
    return scored.select(*(F.col(f"`{c}`") for c in keep), spans.alias(name))


def scan(docs: DataFrame, text: str = "text", name: str = "secret", false_discovery: float = FALSE_DISCOVERY, limits: dict | None = None) -> DataFrame:
    """docs with a column `name`: array of (start, stop, kind number, match), by start, then kind as in KINDS. limits: thresholds() of another corpus."""
    docs = docs.drop(name, f"{name}_base", f"{name}_tested", f"{name}_decoys")
    return _chosen(docs, text, name, false_discovery, limits, docs.columns)


def written(spans: str) -> str:
    """SQL: spans as kind:start:end, comma-joined."""
    return f"array_join(transform({spans}, s -> concat(element_at(array({', '.join(map(_quote, KINDS))}), s.kind + 1), ':', s.start, ':', s.stop)), ',')"


def p_values(spans: str) -> str:
    """SQL: the battery's p-value of each span (of the value of an assignment), comma-joined; '-' where no encoding fits."""
    token = f"if(x.kind = 0, regexp_extract(x.match, {_quote(_ASSIGN)}, 2), x.match)"
    return f"array_join(transform({spans}, x -> coalesce(cast(round({_with_p(token)}.p, 4) as string), '-')), ',')"


def report(docs: DataFrame) -> DataFrame:
    """doc_id, spans found of each pattern, the digest of the patterns' spans, all spans, and the battery's p-value of each span."""
    out = _chosen(docs.select("doc_id", "text"), "text", "s", FALSE_DISCOVERY, None, ["doc_id"])
    count = lambda k: F.expr(f"cast(size(filter(s, x -> x.kind = {k})) as bigint)")
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.expr(f"sha2({written('filter(s, x -> x.kind < 3)')}, 256)").alias("base_sha256"), F.expr(written("s")).alias("spans"), F.expr(p_values("s")).alias("p_values"))


def redact(docs: DataFrame, mark: str = "<secret>", limits: dict | None = None) -> DataFrame:
    """docs with every span of `text` replaced by a mark (and n_chars, if there is one, of the new text)."""
    s = "__secret"
    out = scan(docs, name=s, limits=limits)
    # overlapping spans are joined: a span begins a cut only where those before it have ended; pieces are put together CHUNK by CHUNK
    piece = f"concat(substring(text, a.at + 1, x.start - a.at), {_quote(mark)})"
    cut = f"""aggregate({s}, named_struct('at', 0, 'chunk', '', 'n', 0, 'done', cast(array() as array<string>)), (a, x) -> CASE
        WHEN x.start < a.at THEN named_struct('at', greatest(a.at, x.stop), 'chunk', a.chunk, 'n', a.n, 'done', a.done)
        WHEN a.n < {CHUNK} THEN named_struct('at', x.stop, 'chunk', concat(a.chunk, {piece}), 'n', a.n + 1, 'done', a.done)
        ELSE named_struct('at', x.stop, 'chunk', {piece}, 'n', 1, 'done', array_append(a.done, a.chunk)) END,
        a -> concat(array_join(a.done, ''), a.chunk, substring(text, a.at + 1)))"""
    clean = F.expr(f"if(size({s}) = 0, text, {cut})")
    new = {"text": clean} | ({"n_chars": F.expr(f"if(size({s}) = 0, n_chars, cast(length({cut}) as {docs.schema['n_chars'].dataType.simpleString()}))")} if "n_chars" in docs.columns else {})
    return out.withColumns(new).select(*(f"`{c}`" for c in docs.columns))
