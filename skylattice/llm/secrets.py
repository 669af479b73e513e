"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regex is parsed into a Boolean query over trigrams (of the lower-cased text) that every match must contain:
runs of literals, small classes and alternatives give ORs of ANDs. The index holds posting lists (bucket, trigram) ->
texts for the trigrams that some rule asks for; a rule's query intersects and unites posting lists, bucket by bucket, and
its regex verifies the candidates that come out. Rules without a mandatory trigram (a bare hex run) scan every text.

Texts are keyed by their MD5, so copies share postings and verification keeps whole rows: nulls in the id, repeated
rows and equal texts each keep their own result. A bucket holds about BUCKET texts, so no list grows with the corpus. The
join of rows to candidates is an inner equi-join on the text's key that adaptive execution splits where a text is hot.
Positions are code points, ends exclusive. Null text counts as empty and has no spans.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stage

BUCKET, RUN = 2048, 256


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, and the group that must have `least` characters (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Base kinds first, in the order that breaks ties. A run that is matched whole and then measured equals a
# run with the least length in its pattern, except for `assign`, where a short match still uses up its characters.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_?key")
BASE = (
    Rule("assign", "(" + "|".join(map(either_case, ASSIGN_WORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("key_block", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("repo_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED

Query = tuple  # ("and" | "or", parts) with trigrams as leaves; ("and", ()) asks for nothing


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every match of the pattern satisfies."""
    most = 256

    def strings(words: set[str]) -> Query:
        if any(len(w) < 3 for w in words):
            return ("and", ())
        return ("or", tuple(("and", tuple(sorted({w[i : i + 3] for i in range(len(w) - 2)}))) for w in sorted(words)))

    def exact(node) -> set[str] | None:
        op, arg = node
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN:
            chars = set()
            for kind, x in arg:
                if kind is sre.LITERAL:
                    chars.add(chr(x).lower())
                elif kind is sre.RANGE and x[1] - x[0] < 8:
                    chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None
            return chars if len(chars) <= 8 else None
        if op is sre.SUBPATTERN:
            return joined(arg[3])
        if op is sre.BRANCH:
            parts = [joined(x) for x in arg[1]]
            return None if None in parts else set().union(*parts)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1:
            one = joined(arg[2])
            return None if one is None else one | ({""} if arg[0] == 0 else set())
        return None

    def joined(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            part = exact(node)
            if part is None or len(out) * len(part) > most:
                return None
            out = {a + b for a, b in itertools.product(out, part)}
        return out

    def walk(nodes) -> list[Query]:
        found, run = [], {""}
        for node in nodes:
            part = exact(node)
            if part is not None and len(run) * len(part) <= most:
                longer = {a + b for a, b in itertools.product(run, part)}
                # a run that a short alternative would spoil is closed before it
                if "" in part and all(len(w) >= 3 for w in run):
                    found.append(strings(run))
                    run = {""}
                    continue
                run = longer
                continue
            found.append(strings(run))
            run = {""}
            if part is not None:
                run = part
            elif node[0] is sre.SUBPATTERN:
                found += walk(node[1][3])
            elif node[0] in (sre.MAX_REPEAT, sre.MIN_REPEAT) and node[1][0] >= 1:
                found += walk(node[1][2])
            elif node[0] is sre.BRANCH:
                options = [walk(x) for x in node[1][1]]
                if all(options):
                    found.append(("or", tuple(("and", tuple(o)) for o in options)))
        found.append(strings(run))
        return [q for q in found if q != ("and", ())]

    return simplify(("and", tuple(walk(sre_parse.parse(pattern)))))


def simplify(q: Query) -> Query:
    if isinstance(q, str):
        return q
    op, parts = q[0], tuple(dict.fromkeys(simplify(p) for p in q[1]))
    return parts[0] if len(parts) == 1 else (op, parts)


def leaves(q: Query) -> set[str]:
    return {q} if isinstance(q, str) else set().union(*map(leaves, q[1]), set())


def _lookup(q: Query, ids: dict[str, int]) -> Column:
    if isinstance(q, str):
        return F.coalesce(F.try_element_at("lists", F.lit(ids[q])), F.expr("cast(array() as array<string>)"))
    step = F.array_intersect if q[0] == "and" else F.array_union
    return reduce(step, (_lookup(p, ids) for p in q[1]))


def candidates(texts: DataFrame, rules: tuple[Rule, ...], buckets: int) -> DataFrame:
    """(key, mask): the texts (columns key, text) that satisfy a rule's trigram query; bit k stands for rule k."""
    queries = {k: q for k, q in enumerate(trigram_query(r.pattern) for r in rules) if q != ("and", ())}
    terms = sorted(set().union(*(leaves(q) for q in queries.values()), set()))
    ids = {t: k for k, t in enumerate(terms)}
    low = texts.select("key", F.lower("text").alias("low"))
    has = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(ids[t])) for t in terms)))
    postings = low.select("key", F.explode(has).alias("term")).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    lists = postings.groupBy("bucket", "term").agg(F.collect_set("key").alias("keys"))
    index = lists.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("term", "keys"))).alias("lists"))
    found = F.array(*(F.struct(F.lit(1 << k).alias("bit"), _lookup(q, ids).alias("keys")) for k, q in queries.items()))
    return index.select(F.explode(found).alias("r")).select("r.bit", F.explode("r.keys").alias("key")).groupBy("key").agg(F.bit_or("bit").alias("mask"))


def let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op) -> Column:
    """Running totals of an array of integers under an associative op with identity 0, in runs of RUN, so that arrays grow within a run only."""
    none = F.expr("cast(array() as array<int>)")
    within = lambda of, start, keep: F.aggregate(of, F.struct(start.alias("at"), none.alias("out")), lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(keep(acc["at"], x))).alias("out")), lambda acc: acc["out"])

    def in_runs(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int"))), lambda i: F.slice(v, i * RUN + 1, RUN))
        return let(runs, lambda r: F.flatten(F.zip_with(r, within(F.transform(r, lambda x: F.aggregate(x, F.lit(0), op)), F.lit(0), lambda at, x: at), lambda x, start: within(x, start, op))))

    return let(values, in_runs)


NONE = "cast(array() as array<struct<start: int, kind: int, end: int>>)"


def _spans(text: Column, number: int, rule: Rule) -> Column:
    """array<struct<start, kind, end>> of the leftmost non-overlapping matches that are long enough."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    sizes = F.zip_with(F.split(text, rule.pattern, -1), found, lambda a, b: F.struct(F.coalesce(F.length(a), F.lit(0)).alias("gap"), F.length(b).alias("n")))
    if rule.group:
        sizes = F.zip_with(sizes, F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda a, b: F.struct(a["gap"].alias("gap"), a["n"].alias("n"), (F.length(b) >= rule.least).alias("ok")))
    else:
        sizes = F.transform(sizes, lambda a: F.struct(a["gap"].alias("gap"), a["n"].alias("n"), F.lit(True).alias("ok")))

    def placed(found: Column) -> Column:
        ends = running(F.transform(found, lambda a: a["gap"] + a["n"]), lambda x, y: x + y)
        spans = F.zip_with(found, ends, lambda a, end: F.struct((end - a["n"]).alias("start"), F.lit(number).alias("kind"), end.alias("end"), a["ok"].alias("ok")))
        return F.transform(F.filter(spans, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    return F.when(text.rlike(rule.pattern), let(F.filter(sizes, lambda a: a["n"].isNotNull()), placed)).otherwise(F.expr(NONE))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", out: str = "__spans") -> DataFrame:
    """docs with the column `out`: array<struct<start, kind, end>> sorted by start and kind; kind is the rule's number.

    docs may have columns of any names but `out` (ValueError)."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has a column {out}")
    key, mask = fresh(docs, "__key"), fresh(docs, "__mask")
    rows = docs.withColumn(key, F.md5(F.coalesce(docs[text_col], F.lit(""))))
    buckets = max(1, docs.count() // BUCKET)
    hits = candidates(rows.select(F.col(key).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), rules, buckets)
    # written, as a join with an aggregate on its own key can't be split where a text is hot
    hits = stage(hits, "hits")
    met = rows.join(hits.select(F.col("key").alias(key), F.col("mask").alias(mask)), key, "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = []
    for k, r in enumerate(rules):
        full = trigram_query(r.pattern) == ("and", ())
        parts.append(_spans(text, k, r) if full else F.when(F.coalesce(F.col(mask), F.lit(0)).bitwiseAND(F.lit(1 << k)) != 0, _spans(text, k, r)).otherwise(F.expr(NONE)))
    return met.withColumn(out, F.array_sort(F.concat(*parts))).select(*(met[c] for c in docs.columns), out)


def describe(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of spans, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """docs with every span replaced by [kind]; overlapping spans become one, named for the first. Null texts stay null.

    Pieces are cut from a fixed-width encoding and joined once, so the work is in proportion to the text however many spans it has."""
    kinds = F.array(*(F.lit(f"[{r.kind}]") for r in rules))
    text, wide = F.col(text_col), "UTF-32"
    cut = lambda data, a, b: F.decode(F.substring(data, a * 4 + 1, (b - a) * 4), wide)

    def masked(spans: Column, data: Column) -> Column:
        # the end of all spans before: a span that starts at or after it begins a new mask, others belong to the last one
        ends = running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
        said = F.zip_with(spans, before, lambda s, at: F.when(s["start"] >= at, F.concat(cut(data, at, s["start"]), F.get(kinds, s["kind"]))).otherwise(""))
        return F.concat(F.array_join(said, ""), cut(data, F.element_at(ends, -1), F.octet_length(data).cast("int") / 4))

    spans = fresh(docs, "__spans")
    found = scan(docs, rules, text_col, spans)
    made = let(F.encode(text, wide), lambda data: let(F.col(spans), lambda s: masked(s, data)))
    return found.withColumn(text_col, F.when(F.size(spans) > 0, made).otherwise(text)).select(*docs.columns)


def digest_sql() -> str:
    """DuckDB SQL for the contract query."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = []
    for k, r in enumerate(RULES):
        ok = f"length(regexp_extract_all(t, {q(r.pattern)}, {r.group})[i]) >= {r.least}" if r.group else "true"
        kinds.append(
            f"list_transform(list_filter(range(1, len(regexp_extract_all(t, {q(r.pattern)})) + 1), lambda i: {ok}), lambda i: "
            f"{{'s': cast(list_sum(list_transform(regexp_split_to_array(t, {q(r.pattern)})[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(t, {q(r.pattern)})[1:i-1], lambda x: length(x))), 0) as bigint), "
            f"'k': {k}, 'n': length(regexp_extract_all(t, {q(r.pattern)})[i])}})"
        )
    names = "[" + ", ".join(q(r.kind) for r in RULES) + "]"
    said = lambda spans: f"coalesce(array_to_string(list_transform(list_sort({spans}), lambda x: {names}[x.k + 1] || ':' || x.s || ':' || (x.s + x.n)), ','), '')"
    return f"""
        with a as (select doc_id, coalesce(text, '') t from documents),
        b as (select doc_id, {kinds[0]} a0, {kinds[1]} a1, {kinds[2]} a2, list_concat({", ".join(kinds[3:])}) a3 from a)
        select doc_id, cast(len(a0) as bigint) n_assign, cast(len(a1) as bigint) n_access, cast(len(a2) as bigint) n_hex,
            sha256({said("list_concat(a0, a1, a2)")}) base_sha256, {said("list_concat(a0, a1, a2, a3)")} spans from b"""
