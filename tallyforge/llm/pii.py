"""Personal data by weak supervision, with DataFrame functions only.

Candidates are the matches of the base patterns and of looser ones (obfuscated or unusually grouped). Five labelers vote
on each, +1, 0 or -1: the base rule, a checksum or range check, a gazetteer (top-level domains, issuer prefixes, number
plans, address classes), words of the context, and the characters around. The vote patterns are counted over all
documents; expectation-maximisation over these counts (a table bounded by the number of patterns) estimates the labelers'
reliabilities and each pattern's probability. With these as soft labels a logistic span classifier over votes and shape
features is fitted, again on counts. It decides about every candidate; spans that the base rules give always stay.

A match's start is the sum of the lengths of the gaps and matches before it, so positions need no user code. The patterns
are written so that each is tried once per run of its characters: long texts cost time in proportion.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved

KINDS = ["email", "ip", "card", "phone", "secret"]
LABELERS = 5

#: The base patterns, possessive and tried once a run: same matches, no backtracking.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser forms: written-out signs (a plain dot only behind a sign in brackets), other separators, national numbers; and
#: credentials, which have no base pattern: what a label assigns, and keys that tell themselves by their first letters.
LOOSE = {
    "email": r"(?i)(?:(?<![a-z0-9._%+-])|\G)[a-z0-9._%+-]{1,64}+(?: ?(?:\[at\]|\(at\)) ?[a-z0-9-]{1,63}+(?:(?:\.| ?\[dot\] ?| ?\(dot\) ?| dot )[a-z0-9-]{2,63}+){1,4}+| at [a-z0-9-]{1,63}+(?:(?: ?\[dot\] ?| ?\(dot\) ?| dot )[a-z0-9-]{2,63}+){1,4}+)",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}+){3}",
    "card": r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "secret": r"(?i:\b(?:password|passwd|pwd|passphrase|token|secret|api[_-]?key|access[_-]?key)\b[\"']? ?[=:] ?[\"']?)[A-Za-z0-9+/_.-]{8,512}+|\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:ghp|gho|ghs|glpat|xox[abprs]|sk|pk|rk)[_-][A-Za-z0-9_-]{16,512}+",
}

#: Gazetteers.
DOMAINS = ["com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "de", "fr", "es", "uk", "it", "nl", "eu", "us", "ca", "ch", "at", "be", "pl", "jp", "in", "br", "au"]
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|contacter|kontakt|correo|write|reach)\b",
    "ip": r"(?i)\b(ip|host|server|client|login|from|address|adresse|addr)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(phone|tel|telephone|call|mobile|cell|fax|telefon|anruf|t.l.phone|tel.fono|whatsapp)\b",
    "secret": r"(?i)\b(login|credentials?|user|account|auth|aws|bearer|private|export|secret|key)\b",
}
AGAINST = r"(?i)\b(version|ver|v|release|build|order|invoice|isbn|issn|serial|sku|ticket|bytes|rev|example|page)\b"
CONTEXT_CHARS = 32
ROUNDS, STEPS = 30, 300


def _starts(steps: str) -> str:
    """SQL for the running sums of an array, in blocks so that long arrays don't cost their square."""
    none = "cast(array() as array<int>)"
    sums = f"transform(sequence(0, (size({steps}) - 1) div 256), b -> aggregate(slice({steps}, b * 256 + 1, 256), 0, (x, y) -> x + y))"
    heads = f"aggregate({sums}, named_struct('at', 0, 'out', {none}), (s, y) -> named_struct('at', s.at + y, 'out', concat(s.out, array(s.at))), s -> s.out)"
    inner = f"aggregate(slice({steps}, b * 256 + 1, 256), named_struct('at', h, 'out', {none}), (s, y) -> named_struct('at', s.at + y, 'out', concat(s.out, array(s.at + y))), s -> s.out)"
    return f"flatten(transform({heads}, (h, b) -> {inner}))"


def _matches(rows: DataFrame, name: str, pattern: str, guard: Column) -> DataFrame:
    """rows with the array `name` of struct<start, end, hit, before, after> of the pattern's matches in `text`."""
    hits, gaps, steps, starts = (f"{name}_{x}" for x in ("hits", "gaps", "steps", "starts"))
    rows = rows.withColumn(hits, F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    rows = rows.withColumn(gaps, F.when(F.size(F.coalesce(hits, F.array().cast("array<string>"))) > 0, F.split("text", pattern, -1)))
    rows = rows.withColumn(steps, F.expr(f"transform({hits}, (h, i) -> length({gaps}[i]) + if(i > 0, length({hits}[i - 1]), 0))"))
    rows = rows.withColumn(starts, F.when(F.col(gaps).isNotNull(), F.expr(_starts(steps))))
    made = f"transform({hits}, (h, i) -> named_struct('start', {starts}[i], 'end', {starts}[i] + length(h), 'hit', h, 'before', right({gaps}[i], {CONTEXT_CHARS}), 'after', left({gaps}[i + 1], 1)))"
    empty = "cast(array() as array<struct<start:int,end:int,hit:string,before:string,after:string>>)"
    return rows.withColumn(name, F.when(F.col(gaps).isNotNull(), F.expr(made)).otherwise(F.expr(empty))).drop(hits, gaps, steps, starts)


def _luhn(digits: str) -> str:
    one = f"cast(substring({digits}, -i, 1) as int)"
    return f"aggregate(sequence(1, length({digits})), 0, (a, i) -> a + if(i % 2 = 1, {one}, if({one} > 4, {one} * 2 - 9, {one} * 2))) % 10 = 0"


def _valid(kind: str, hit: str) -> str:
    """SQL: whether a match passes the kind's check."""
    digits = f"regexp_replace({hit}, '[^0-9]', '')"
    if kind == "ip":
        return f"forall(regexp_extract_all({hit}, '[0-9]+', 0), p -> length(regexp_replace(p, '^0+', '')) < 3 or (length(regexp_replace(p, '^0+', '')) = 3 and regexp_replace(p, '^0+', '') <= '255'))"
    if kind == "card":
        return f"(length({digits}) between 16 and 19 and exists(array({digits}), d -> {_luhn('d')}))"
    if kind == "phone":
        return f"(length({digits}) between 8 and 15)"
    if kind == "secret":  # letters and digits without a gap
        return f"({hit} rlike '[0-9][^ ]*[A-Za-z]|[A-Za-z][^ =:]*[0-9]' and {hit} rlike '[A-Za-z0-9+/_.-]{{8,}}$')"
    return "true"


def _gazetteer(kind: str, hit: str) -> str:
    if kind == "email":
        names = ", ".join(f"'{d}'" for d in DOMAINS)
        return f"if(lower(regexp_extract({hit}, '([A-Za-z0-9-]+)$', 1)) in ({names}), 1, -1)"
    if kind == "ip":
        return f"if({hit} rlike '^0*([1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])[^0-9]' and not {hit} rlike '^0*127[^0-9]', 1, -1)"
    if kind == "card":
        return f"if({hit} rlike '^(4|5[1-5]|2[2-7]|3[47]|6)', 1, -1)"
    if kind == "secret":
        return f"if({hit} rlike '^(AKIA|ASIA|gh[pos]_|glpat-|xox[abprs]-|[spr]k[_-])|(?i)^(password|passwd|pwd|api.?key|access.?key)|[0-9a-f]{{16,}}$', 1, -1)"
    return f"if({hit} rlike '^[+(]*[1-9]', 1, -1)"


def _labelled(kind: str, base: bool) -> str:
    """SQL: a match as a candidate with its votes and shape features."""
    check = f"if({_valid(kind, 'm.hit')}, 1, -1)"
    rule = f"if({_valid(kind, 'm.hit')}, 1, -1)" if base else "0"
    context = f"if(m.before rlike '{CONTEXT[kind]}', 1, if(m.before rlike '{AGAINST}', -1, 0))"
    around = "if(m.before rlike '[A-Za-z0-9_]$' or m.after rlike '^[A-Za-z0-9_]', -1, 1)"
    length = "least(length(m.hit) div 8, 4)"
    digits = "cast(4 * length(regexp_replace(m.hit, '[^0-9]', '')) / length(m.hit) as int)"
    given = f"({_valid(kind, 'm.hit')})" if base else "false"
    votes = f"array({rule}, {check}, {_gazetteer(kind, 'm.hit')}, {context}, {around})".replace("\\", "\\\\")
    return f"named_struct('kind', {KINDS.index(kind)}, 'start', m.start, 'end', m.end, 'base', {given}, 'votes', {votes}, 'shape', array({length}, {digits}))"


def candidates(docs: DataFrame, keep: bool = False) -> DataFrame:
    """doc_id and the array `found` of candidates of each document, in the order of KINDS, base ones first; with keep, the
    struct `row` of all columns of docs too."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(*[row] * keep, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digits", F.col("text").rlike("[0-9]"))
    digits = F.col("digits")
    guard = {"email": F.contains("text", F.lit("@")), "ip": digits, "card": digits, "phone": digits & F.contains("text", F.lit("+"))}
    loose = {"email": F.col("text").rlike(r"(?i)[\[(]at[\])]|[\[( ]dot[\]) ]"), "ip": digits, "card": digits, "phone": digits, "secret": digits}
    for kind in KINDS:
        if kind in BASE:
            rows = _matches(rows, kind, BASE[kind], guard[kind])
        rows = _matches(rows, f"{kind}_loose", LOOSE[kind], loose[kind])
    rows = rows.drop("text", "digits")
    for kind in KINDS:
        if kind in BASE:
            rows = rows.withColumn(kind, F.expr(f"transform({kind}, m -> {_labelled(kind, True)})"))
        rows = rows.withColumn(f"{kind}_loose", F.expr(f"transform({kind}_loose, m -> {_labelled(kind, False)})"))
    rows = rows.withColumn("given", F.filter(F.concat(*BASE), lambda c: c["base"]))
    free = lambda c: ~F.exists("given", lambda g: (g["start"] < c["end"]) & (c["start"] < g["end"]))
    others = F.filter(F.concat(*BASE, *[f"{k}_loose" for k in KINDS]), lambda c: ~c["base"] & free(c))
    return rows.select(*["row"] * keep, "doc_id", F.concat("given", others).alias("found"))


def em(patterns: dict[tuple, float]) -> tuple[dict[int, float], dict[tuple, float]]:
    """From counts of (kind, vote 1, ...): the labelers' accuracies and each pattern's probability of being personal data."""
    p = {x: 1 / (1 + math.exp(-sum(x[1:]))) for x in patterns}  # from the majority of the votes
    kinds = sorted({x[0] for x in patterns})
    for _ in range(ROUNDS):
        prior, rate = {}, {}
        for k in kinds:
            own = [(x, n) for x, n in patterns.items() if x[0] == k]
            yes, total = sum(n * p[x] for x, n in own), sum(n for _, n in own)
            prior[k] = (yes + 1) / (total + 2)
            for i in range(1, LABELERS + 1):
                for vote in (-1, 0, 1):
                    hit = sum(n * p[x] for x, n in own if x[i] == vote)
                    miss = sum(n * (1 - p[x]) for x, n in own if x[i] == vote)
                    # a vote for something is taken to be likelier right than wrong before any count
                    rate[k, i, vote] = ((hit + (2.0 if vote > 0 else 0.5)) / (yes + 3), (miss + (2.0 if vote < 0 else 0.5)) / (total - yes + 3))
        for x in patterns:
            odds = math.log(prior[x[0]] / (1 - prior[x[0]])) + sum(math.log(rate[x[0], i, x[i]][0] / rate[x[0], i, x[i]][1]) for i in range(1, LABELERS + 1))
            p[x] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    right = {i: sum(n * (p[x] if x[i] > 0 else 1 - p[x]) for x, n in patterns.items() if x[i]) / max(1e-9, sum(n for x, n in patterns.items() if x[i])) for i in range(1, LABELERS + 1)}
    return right, p


def fitted(cells: list[tuple[tuple, float, float]]) -> dict[str, float]:
    """Weights of a logistic classifier from (features, probability, count), by gradient descent with a small penalty."""
    named = [([f"{i}={v}" for i, v in enumerate(x)], p, n) for x, p, n in cells]
    total = sum(n for _, _, n in named) or 1
    weights = dict.fromkeys((f for x, _, _ in named for f in x), 0.0) | {"": 0.0}
    for _ in range(STEPS):
        slope = {f: 1e-3 * w for f, w in weights.items()}
        for x, p, n in named:
            off = (1 / (1 + math.exp(-weights[""] - sum(weights[f] for f in x))) - p) * n / total
            for f in (*x, ""):
                slope[f] += off
        for f in weights:
            weights[f] -= 1.5 * slope[f]
    return weights


def _features(kind, votes, shape) -> tuple:
    return (kind, *(3 * kind + v for v in votes), *(10 * kind + s for s in shape))


def learned(found: DataFrame) -> tuple[dict[str, float], dict[int, float]]:
    """The classifier's weights, from the candidates of all documents, and the labelers' accuracies as estimated, by number."""
    # whole structs from end to end: taking their fields would make the optimiser repeat the arrays' expressions
    cells = F.transform("found", lambda c: F.struct(c["kind"].alias("kind"), c["votes"].alias("votes"), c["shape"].alias("shape")))
    counts = found.select(F.explode(cells).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted((*r["c"], r["n"]) for r in counts)  # at most 5 * 3**5 * 5 * 5 cells
    patterns: dict[tuple, float] = {}
    for r in rows:
        key = (r[0], *r[1])
        patterns[key] = patterns.get(key, 0.0) + r[3]
    right, p = em(patterns)
    return fitted([(_features(kind, votes, shape), p[(kind, *votes)], float(n)) for kind, votes, shape, n in rows]), right


def classified(found: DataFrame, weights: dict[str, float]) -> DataFrame:
    """found with `kept`, the accepted candidates sorted by kind and start, in place of the candidates."""
    table = F.create_map(*[F.lit(x) for f, w in sorted(weights.items()) for x in (f, w)])
    weight = lambda i, v: F.coalesce(F.element_at("weights", F.concat(F.lit(f"{i}="), v.cast("string"))), F.lit(0.0))

    def logit(c: Column) -> Column:
        named = _features(c["kind"], [c["votes"][i] for i in range(LABELERS)], [c["shape"][i] for i in range(2)])
        out = F.lit(weights[""])
        for i, value in enumerate(named):
            out = out + weight(i, value)
        return out

    kept = F.filter("found", lambda c: c["base"] | (logit(c) > 0))
    bare = F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))
    return found.withColumn("weights", table).withColumn("kept", F.array_sort(F.array_distinct(bare))).drop("weights", "found")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.element_at(names, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added, n_spans.

    A null or empty text has no spans. Spans are kind:start:end in code points, end exclusive, by kind as listed and start;
    kind `secret` (credentials) has no base spans. Rows that repeat an id or a text each get a row; extra columns are ignored;
    an empty table gives no rows. Very long texts are scanned whole.
    """
    found = saved(candidates(docs), "candidates", small=True)
    weights, _ = learned(found)
    rows = classified(found, weights)
    base = F.filter("kept", lambda c: c["base"])
    count = lambda k: F.size(F.filter("kept", lambda c: c["base"] & (c["kind"] == KINDS.index(k)))).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("kept")).alias("spans"), (F.size("kept") - F.size(base)).cast("long").alias("n_added"), F.size("kept").cast("long").alias("n_spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span found replaced by its kind in brackets; n_chars, where docs has it, follows. Overlapping spans are
    replaced together by the first one's kind. Null texts stay null; repeated rows, null ids and extra columns stay as they are.

    docs is read twice, once for the counts that the classifier is fitted on; nothing is joined or written on the way."""
    weights, _ = learned(candidates(docs))
    once = lambda rows, name: rows.withColumn(name, F.explode(F.array(name)))  # noqa: E731  keeps the optimiser from repeating the array's expression
    rows = once(classified(once(candidates(docs, keep=True), "found"), weights), "kept")
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    order = "array_sort(transform(kept, c -> struct(c.start, c.end, c.kind)))"
    cut = (
        f"aggregate({order}, named_struct('at', 0, 'out', cast(array() as array<string>)), (s, c) -> named_struct("
        f"'at', greatest(s.at, c.end), 'out', if(c.start >= s.at, concat(s.out, array(substring(row.text, s.at + 1, c.start - s.at), array({names})[c.kind])), s.out)), "
        f"s -> concat(array_join(s.out, ''), substring(row.text, s.at + 1)))"
    )
    rows = rows.withColumn("clean_text", F.when(F.size("kept") > 0, F.expr(cut)).otherwise(F.col("row.text")))
    changed = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("kept") > 0, F.length("clean_text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
