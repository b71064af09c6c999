"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Candidates are what four strict patterns match (email, ip, card, phone) and
what four looser ones match outside of them (bracketed "at" and "dot", long
address groups, national phone numbers, and secrets: runs of 20 or more key
characters with letters and digits). A card run whose checksum fails is none.
Strict matches that pass their check (parts up to 255, 14 to 19 digits with a
valid checksum, 10 to 15 digits) are base spans and always stay.

Five labelers, each with evidence of its own, vote +1, -1 or abstain on each
candidate: a regex on its form (grouping, alphabet), the checksum, count or
variety of its characters, a gazetteer (top-level domains, issuer, country and
key prefixes, reserved networks), cue words in the context (the 24 characters
before it and the 16 after it, as far as the next match of its pattern), and
the characters at its ends. Candidates with equal votes are alike to them, so one aggregate
counts vote patterns (at most 5 kinds x 3 ** 5) and expectation-maximisation
runs on the counts: it estimates each labeler's reliability and from these the
probability that a pattern is personal data. A second aggregate sums these
probabilities by span feature (length, separators, digits, neighbours) and the
sums are the weights of the final classifier, naive Bayes over the features
with the votes' posterior as prior. A candidate that is no base span stays if
its probability reaches ``accept``.

Everything runs as DataFrame functions; the driver sees counts of bounded
number only. Offsets are code points: the text between matches (``split``) and
the matches (``regexp_extract_all``) of one pattern alternate, so running
lengths give every place.

Scale: texts are read once to write candidate spans, without a shuffle; counts
combine map-side.

Edge cases: a null text counts as empty and has no spans; of spans with one
start the kinds come as listed; rows that repeat get
equal results; empty input gives no rows; very long runs of digits or name
characters are matched possessively, in linear time; other columns are kept by
``redact`` and not read otherwise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm import store

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret"]
LABELERS = ["v_regex", "v_check", "v_gazetteer", "v_context", "v_ends"]
FEATURES = ["f_length", "f_digits", "f_gaps", "f_before", "f_after"]

# Strict patterns. A name, a digit run or a card run can only begin where the
# run begins (or where the last match ended), which keeps long runs linear.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+-])[A-Za-z0-9_+-]{20,}+",
}
# A text without a match of these has no match of the pattern.
STRICT_GUARD = {
    "email": "contains(text, '@')",
    "ip": r"text rlike '[0-9]\\.[0-9]++\\.[0-9]'",
    "card": r"text rlike '[0-9](?:[\\x20-]?[0-9]){12}'",
    "phone": r"text rlike '\\+[0-9]'",
}
LOOSE_GUARD = {
    "email": r"text rlike '[\\[(](?:at|AT)[\\])]'",
    "ip": r"text rlike '[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:'",
    "phone": r"text rlike '[0-9]{3}[\\x20.-][0-9]{4}'",
    "secret": r"text rlike '(?<![A-Za-z0-9_+-])[A-Za-z0-9_+-]{20}'",
}
# Gazetteers.
DOMAINS = "com org net edu gov io info de fr es uk eu co us ch at be nl it pt example test".split()
CARD_PREFIX = "^(?:4|5[1-5]|2[2-7]|3[47]|36|6011|65|35)"
COUNTRY_PREFIX = r"^\\+(?:1|7|2[07]|3[0-46-9]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = "^(?:0|127|2(?:2[4-9]|[34][0-9]|5[0-5]))\\\\."
KEY_PREFIX = "^(?:AKIA|ASIA|AIza|gh[pousr]_|glpat-|sk-|xox[abprs]-|eyJ)"
CUES = {
    "email": "mail|contact|write|schreib|courriel|correo",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|visa|karte|carte|tarjeta|pay|iban|account",
    "phone": "tel|phone|call|mobil|fax|anruf|appel|llam",
    "secret": "token|secret|key|passw|pwd|auth|bearer|credential",
}
_NUMBERED = "version|release|isbn|issn|order|invoice|token|serial|hash|doi"
COUNTER_CUES = {**dict.fromkeys(BASE_KINDS, _NUMBERED), "secret": "commit|sha|md5|hash|checksum|digest|revision|uuid"}

_SPAN = "struct<kind:string,start:int,end:int,found:string,before:string,after:string,strict:boolean>"


def _quote(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _matches(kind: str, pattern: str, guard: str, strict: bool) -> str:
    """SQL for the array of matches of one pattern in ``text``, with their places and surroundings."""
    p = _quote(pattern)
    return f"""
      CASE WHEN {guard} THEN
        aggregate(
          arrays_zip(slice(split(text, '{p}', -1), 1, size(regexp_extract_all(text, '{p}', 0))) AS gap,
                     regexp_extract_all(text, '{p}', 0) AS found,
                     slice(split(text, '{p}', -1), 2, size(regexp_extract_all(text, '{p}', 0))) AS next),
          named_struct('at', 0, 'out', CAST(array() AS array<{_SPAN}>)),
          (acc, x) -> named_struct(
            'at', acc.at + length(x.gap) + length(x.found),
            'out', concat(acc.out, array(named_struct(
              'kind', '{kind}', 'start', acc.at + length(x.gap), 'end', acc.at + length(x.gap) + length(x.found),
              'found', x.found, 'before', right(x.gap, 24), 'after', left(x.next, 16), 'strict', {str(strict).lower()})))),
          acc -> acc.out)
      ELSE CAST(array() AS array<{_SPAN}>) END"""


def _zipped(kind: str, pattern: str, guard: str, strict: bool) -> str:
    # arrays_zip names its fields by position when its inputs have no names.
    sql = _matches(kind, pattern, guard, strict)
    for name, at in (("gap", "0"), ("found", "1"), ("next", "2")):
        sql = sql.replace(f" AS {name}", "").replace(f"x.{name}", f"x['{at}']")
    return sql


_DIGITS = "regexp_replace(s.found, '[^0-9]', '')"
_LUHN = f"""
  aggregate(
    transform(split(reverse({_DIGITS}), ''), (d, i) ->
      CASE WHEN i % 2 = 0 THEN coalesce(try_cast(d AS int), 0)
           ELSE (coalesce(try_cast(d AS int), 0) * 2) div 10 + (coalesce(try_cast(d AS int), 0) * 2) % 10 END),
    0L, (a, d) -> a + d) % 10 = 0"""
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_VALID = f"""CASE s.kind
  WHEN 'email' THEN true
  WHEN 'ip' THEN s.found rlike '^{_PART}(?:\\\\.{_PART}){{3}}$'
  WHEN 'card' THEN length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}
  WHEN 'secret' THEN size(array_distinct(split(s.found, ''))) >= 8
  ELSE length({_DIGITS}) BETWEEN 10 AND 15 END"""


def _votes() -> str:
    domains = "|".join(DOMAINS)
    cue = " ".join(f"WHEN '{k}' THEN '(?i)(?<![A-Za-z])(?:{v})'" for k, v in CUES.items())
    counter = " ".join(f"WHEN '{k}' THEN '(?i)(?<![A-Za-z])(?:{v})[^A-Za-z]*$'" for k, v in COUNTER_CUES.items())
    return f"""named_struct(
      'kind', s.kind, 'start', s.start, 'end', s.end, 'base', s.strict AND ({_VALID}),
      'v_regex', CASE s.kind
        WHEN 'email' THEN CAST(s.strict AS int)
        WHEN 'ip' THEN CASE WHEN NOT s.strict THEN 0 WHEN s.found rlike '^[0-9]{{1,3}}(?:\\\\.[0-9]{{1,3}}){{3}}$' THEN 1 ELSE -1 END
        WHEN 'card' THEN CASE WHEN s.found rlike '^(?:[0-9]{{14,19}}|[0-9]{{4}}([\\\\x20-])[0-9]{{4}}\\\\1[0-9]{{4}}\\\\1[0-9]{{2,7}})$' THEN 1 ELSE -1 END
        WHEN 'phone' THEN CASE WHEN NOT s.strict THEN 0 WHEN s.found rlike '^\\\\+[0-9]{{1,3}}[\\\\x20(.-]' THEN 1 ELSE -1 END
        ELSE CASE WHEN s.found rlike '^(?:[0-9a-f]{{32,}}|[0-9A-F]{{32,}})$' OR (s.found rlike '[a-z]' AND s.found rlike '[A-Z]' AND NOT s.found rlike '-') THEN 1 ELSE -1 END END,
      'v_check', CASE WHEN s.kind = 'email' THEN 0 WHEN NOT ({_VALID}) THEN -1 WHEN s.kind = 'secret' THEN 0 ELSE 1 END,
      'v_gazetteer', CASE s.kind
        WHEN 'email' THEN CASE WHEN s.found rlike '(?i)(?:{domains})$' THEN 1 ELSE -1 END
        WHEN 'ip' THEN CASE WHEN s.found rlike '{RESERVED}' THEN -1 ELSE 0 END
        WHEN 'card' THEN CASE WHEN {_DIGITS} rlike '{CARD_PREFIX}' THEN 1 ELSE -1 END
        WHEN 'secret' THEN CASE WHEN s.found rlike '{KEY_PREFIX}' THEN 1 ELSE 0 END
        ELSE CASE WHEN s.found rlike '{COUNTRY_PREFIX}' THEN 1 WHEN s.strict THEN -1 ELSE 0 END END,
      'v_context', CASE WHEN s.before rlike CASE s.kind {counter} END THEN -1
                        WHEN s.before rlike CASE s.kind {cue} END OR s.after rlike CASE s.kind {cue} END THEN 1 ELSE 0 END,
      'v_ends', CASE WHEN s.before rlike '[A-Za-z0-9]$' OR s.after rlike '^[A-Za-z0-9]' THEN -1
                     WHEN s.kind = 'secret' AND NOT s.before rlike '["\\']$' THEN 0 ELSE 1 END,
      'f_length', least(length(s.found) div 4, 10),
      'f_digits', CAST(floor(4 * length({_DIGITS}) / greatest(length(s.found), 1)) AS int),
      'f_gaps', least(length(regexp_replace(s.found, '[^\\\\x20().:-]', '')), 5),
      'f_before', CASE WHEN s.before = '' THEN 0 WHEN s.before rlike '\\\\s$' THEN 1 WHEN s.before rlike '[A-Za-z0-9]$' THEN 2 ELSE 3 END,
      'f_after', CASE WHEN s.after = '' THEN 0 WHEN s.after rlike '^\\\\s' THEN 1 WHEN s.after rlike '^[A-Za-z0-9]' THEN 2 ELSE 3 END)"""


def candidates(text: Column) -> Column:
    """Array of candidate spans with base flag, votes and features (needs a column named ``text``)."""
    strict = [_zipped(k, STRICT[k], STRICT_GUARD[k], True) for k in BASE_KINDS]
    loose = [_zipped(k, LOOSE[k], LOOSE_GUARD[k], False) for k in LOOSE]
    # A checksum that fails disproves a card; a loose match must not touch a strict one.
    kept = f"filter(concat({', '.join(strict)}), s -> s.kind <> 'card' OR (length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}))"
    # A key has letters and digits.
    free = """filter(z.loose, l -> (l.kind <> 'secret' OR (l.found rlike '[0-9]' AND l.found rlike '[A-Za-z]'))
                                AND NOT exists(z.strict, s -> s.start < l.end AND l.start < s.end))"""
    both = f"""transform(array(named_struct('strict', {kept}, 'loose', concat({', '.join(loose)}))),
                         z -> transform(concat(z.strict, {free}), s -> {_votes()}))[0]"""
    return F.expr(both)


@dataclass(frozen=True)
class Model:
    """Posterior log-odds of each vote pattern, weight of each feature value, and labeler reliabilities."""

    votes: dict[str, float] = field(default_factory=dict)
    features: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, float] = field(default_factory=dict)


def expectation_maximisation(patterns: list[tuple], rounds: int = 60, smooth: float = 1.0) -> tuple[dict, dict]:
    """``(kind, vote pattern) -> probability`` and each labeler's vote probabilities, from pattern counts.

    Two hidden classes per kind, votes independent given the class. Starts from
    the majority of the votes, which also fixes which class is personal data.
    """
    posterior, reliability = {}, {}
    for kind in KINDS:
        mine = [(votes, n) for k, votes, n in patterns if k == kind]
        if not mine:
            continue
        q = {v: 1 / (1 + math.exp(-sum(v))) for v, _ in mine}
        total = sum(n for _, n in mine)
        for _ in range(rounds):
            prior = (sum(q[v] * n for v, n in mine) + smooth) / (total + 2 * smooth)
            rate = {}
            for i, name in enumerate(LABELERS):
                for y in (0, 1):
                    mass = {vote: smooth for vote in (-1, 0, 1)}
                    for v, n in mine:
                        mass[v[i]] += n * (q[v] if y else 1 - q[v])
                    for vote in mass:
                        rate[name, vote, y] = mass[vote] / sum(mass.values())
            for v, _ in mine:
                odds = math.log(prior / (1 - prior))
                for name, vote in zip(LABELERS, v, strict=True):
                    odds += math.log(rate[name, vote, 1] / rate[name, vote, 0])
                q[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        posterior.update({(kind, v): p for v, p in q.items()})
        reliability.update({f"{kind}:{name}:{vote}:{y}": p for (name, vote, y), p in rate.items()})
    return posterior, reliability


def _pattern(span: str) -> str:
    return f"concat_ws(':', {span}.kind, " + ", ".join(f"{span}.{v}" for v in LABELERS) + ")"


def fit(found: DataFrame) -> Model:
    """Model from a table with a ``spans`` column of candidates."""
    spans = found.select(F.explode("spans").alias("s")).select("s.*")
    counts = spans.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).collect()
    posterior, reliability = expectation_maximisation([(r["kind"], tuple(r[v] for v in LABELERS), r["n"]) for r in counts])
    votes = {":".join(map(str, (k, *v))): math.log(max(p, 1e-9) / max(1 - p, 1e-9)) for (k, v), p in posterior.items()}
    if not votes:
        return Model()
    table = {key: 1 / (1 + math.exp(-x)) for key, x in votes.items()}
    weighed = spans.withColumn("s", F.struct("kind", *LABELERS)).withColumn("p", _lookup(table, F.expr(_pattern("s"))))
    value = F.explode(F.array(*[F.concat_ws(":", "kind", F.lit(f), F.col(f).cast("string")) for f in FEATURES]))
    sums = weighed.select("kind", "p", value.alias("value")).groupBy("kind", "value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    whole: dict[tuple, list[float]] = {}
    for r in sums:
        t = whole.setdefault((r["kind"], r["value"].split(":")[1]), [0.0, 0.0, 0])
        t[0], t[1], t[2] = t[0] + r["yes"], t[1] + r["no"], t[2] + 1
    features = {}
    for r in sums:
        yes, no, n = whole[r["kind"], r["value"].split(":")[1]]
        features[r["value"]] = math.log((r["yes"] + 1) / (yes + n)) - math.log((r["no"] + 1) / (no + n))
    return Model(votes, features, reliability)


def _lookup(table: dict[str, float], key: Column) -> Column:
    pairs = [F.lit(x) for k, v in sorted(table.items()) for x in (k, float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(0.0)) if pairs else F.lit(0.0)


def accepted(spans: Column, model: Model, accept: float = 0.5) -> Column:
    """Candidates that are base spans, or whose probability reaches ``accept``; by start, then kind as listed."""
    limit = math.log(accept / (1 - accept))

    def good(s: Column) -> Column:
        score = _lookup(model.votes, F.concat_ws(":", s["kind"], *[s[v].cast("string") for v in LABELERS]))
        for f in FEATURES:
            score = score + _lookup(model.features, F.concat_ws(":", s["kind"], F.lit(f), s[f].cast("string")))
        return s["base"] | (score >= limit)

    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    placed = F.transform(
        F.filter(spans, good),
        lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")),
    )
    return F.array_sort(placed)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, accept: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret`` and ``found`` (the span structs).

    The counts of the four kinds and ``base_sha256`` are of base spans; ``spans``
    lists all, ``n_secret`` counts the accepted secrets.
    """
    found = store.materialise(
        store.documents(docs, id_col, text_col).withColumn("spans", candidates(F.col("text"))).select("doc_id", "spans"), "candidates"
    )
    model = fit(found)
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long) AS n_{k}") for k in BASE_KINDS]
    return (
        found.withColumn("spans", accepted(F.col("spans"), model, accept))
        .withColumn("base", base)
        .select(
            "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
            F.expr("cast(size(filter(spans, s -> s.kind = 'secret')) as long)").alias("n_secret"), F.col("spans").alias("found")
        )
    )


def redact(docs: DataFrame, accept: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every accepted span of the text replaced by its kind in angle brackets.

    Overlapping spans become the first one's mark. A null text stays null.
    """
    read = docs.select(store.as_text(text_col).alias("text")).withColumn("spans", candidates(F.col("text")))
    model = fit(store.materialise(read.select("spans"), "candidates"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    raw = names[docs.columns.index(text_col)]
    inner = docs.toDF(*names).withColumn("text", store.as_text(raw))
    marked = inner.withColumn("spans", accepted(candidates(F.col("text")), model, accept))
    rebuilt = F.expr(
        """aggregate(spans, named_struct('at', 0, 'out', ''),
             (acc, s) -> CASE WHEN s.start < acc.at THEN named_struct('at', greatest(acc.at, s.end), 'out', acc.out)
               ELSE named_struct('at', s.end, 'out', concat(acc.out, substring(text, acc.at + 1, s.start - acc.at), '<', upper(s.kind), '>')) END,
             acc -> concat(acc.out, substring(text, acc.at + 1, length(text))))"""
    )
    new = F.when(F.col(raw).isNull() | (F.size("spans") == 0), F.col(raw)).otherwise(rebuilt)
    return marked.select(*[new if c == raw else F.col(c) for c in names]).toDF(*docs.columns)
