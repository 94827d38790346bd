"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

1. Base spans: four patterns with their exact checks. They always stay.
2. Generators with high recall propose further, overlapping spans: spelled-out
   e-mail addresses, spaced or bracketed addresses, card numbers in other groupings or
   inside longer digit runs, phone numbers in national form.
3. Boosted trees over binned format and context features score each proposal. They
   learn from the corpus itself: every base span and its rewritings into other formats
   are examples, broken copies (a failing check digit, an octet too large, a domain
   without a dot, ...) and proposals that an exact check refutes are counter-examples.
   Equal feature vectors are one row with a count, so the table that is fitted does not
   grow with the corpus; each level of all trees of a round is one aggregate over it.
4. Per kind, the threshold is the least score at which the precision on held-out spans
   (a third, by hash) reaches ``PRECISION``. Proposals from there on that touch no base
   span are added, the better first where they start together.

Positions come from the text between the matches, so a text is read once per pattern and
nothing is joined. Running sums over the matches of one text go chunk by chunk, which
keeps a text with very many of them linear.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlift.llm.common import documents, stored

# Kinds and base patterns, written so that no text makes them backtrack.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
AT = r"(?:[\x20]?@[\x20]?|[\x20]?[\[({][\x20]?(?:at|AT|@)[\x20]?[\])}][\x20]?|[\x20](?:at|AT)[\x20])"
DOT = r"(?:\.|[\x20]?[\[({][\x20]?(?:dot|DOT|\.)[\x20]?[\])}][\x20]?|[\x20](?:dot|DOT)[\x20])"
GENERATORS = [
    ("email", rf"(?<![{LOCAL}])[{LOCAL}]{{1,64}}+{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:[\x20]?[\[(]?\.[\])]?[\x20]?[0-9]{1,3}){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20./_-]?[0-9]{4}){2,3}(?:[\x20./_-]?[0-9]{1,3})?(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("phone", r"(?<![0-9+])(?:(?:00|\+)?[0-9]{1,3}[\x20./-])?\(?[0-9]{2,4}\)?[\x20./-]?[0-9]{3,4}[\x20./-]?[0-9]{3,4}(?![0-9])"),
]
CUES = {
    "email": "mail|contact|correo|courriel|kontakt|write to|escrib|schreib",
    "ip": r"\bip\b|host|server|servidor|serveur|address|adresse",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta|debit",
    "phone": "tel|phone|call|fax|mobile|handy|whatsapp|llam|appel|ruf",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": r"@|[\[({]\x20?(?:at|AT)|\x20(?:dot|DOT)\x20", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}

TREES, LEARNING_RATE, SHRINK = 10, 0.5, 1.0
GRAIN = 1 << 20
PRECISION = 0.99
BASE_RANK = -2.0  # ranks are negative scores; a base span outranks every proposal
LONGEST_LESSON = 256  # longer base spans stay, but teach nothing
CHUNK = 512
CONTEXT = 24
SPAN = "struct<k:int,start:bigint,stop:bigint,m:string,before:string,after:string>"
MARK = "struct<start:bigint,rank:double,stop:bigint,k:int>"


def _raw(pattern: str) -> str:
    """SQL literal of a pattern without single quotes."""
    return f"r'{pattern}'"


# ---- spans ---------------------------------------------------------------------


def chunked(items: str) -> Column:
    """Column ``items``, an array, as an array of arrays of CHUNK."""
    pieces = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(pieces, lambda c: F.slice(items, c * CHUNK + 1, F.lit(CHUNK)))


def folded(df: DataFrame, name: str, items: Column, state: Column, out: str, step) -> DataFrame:
    """Adds ``name``: the arrays that ``step(state, item) -> (state, array)`` emits along ``items``, joined.

    An array that grows by one copies itself each time, so this happens in chunks. Items and
    chunks are columns of their own, which Spark works out once and not once per chunk.
    """

    def one(acc: Column, item: Column) -> Column:
        after, emitted = step(acc["state"], item)
        return F.struct(after.alias("state"), F.concat(acc["out"], emitted).alias("out"))

    def many(acc: Column, chunk: Column) -> Column:
        held = F.aggregate(chunk, F.struct(acc["state"].alias("state"), F.array().cast(out).alias("out")), one)
        both = F.transform(F.array(held), lambda h: F.struct(h["state"].alias("state"), F.concat(acc["out"], F.array(h["out"])).alias("out")))
        return both[0]

    start = F.struct(state.alias("state"), F.array().cast(f"array<{out}>").alias("out"))
    df = df.withColumn("_items", items).withColumn("_chunks", chunked("_items"))
    return df.withColumn(name, F.flatten(F.aggregate("_chunks", start, many)["out"])).drop("_items", "_chunks")


def with_spans(df: DataFrame, patterns: list[tuple[str, str]]) -> DataFrame:
    """Adds span_i, an array of spans, for the i-th (kind, pattern); positions in code points of ``text``."""
    none, nowhere = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    parts, spans = {}, {}
    for i, (kind, pattern) in enumerate(patterns):
        tried = F.col("text").rlike(NEEDS[kind])
        parts[f"_hit{i}"] = F.when(tried, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none)
        parts[f"_gap{i}"] = F.when(tried, F.split("text", pattern, -1)).otherwise(none)
    df = df.withColumns(parts)
    for i in range(len(patterns)):
        hit, gap = F.col(f"_hit{i}"), F.col(f"_gap{i}")
        before = F.concat(F.array(F.lit(0)), F.transform(hit, lambda h: F.length(h)))
        steps = F.slice(F.zip_with(gap, before, lambda g, n: (F.length(g) + n).cast("bigint")), F.lit(1), F.size(hit))
        steps = F.when(F.size(hit) > 0, steps).otherwise(nowhere)
        df = folded(df, f"_at{i}", steps, F.lit(0).cast("bigint"), "array<bigint>", lambda at, n: (at + n, F.array(at + n)))
    for i, (kind, _) in enumerate(patterns):
        k, gap, at = KINDS.index(kind), F.col(f"_gap{i}"), F.col(f"_at{i}")

        def span(h: Column, n: Column) -> Column:
            return F.struct(
                F.lit(k).alias("k"), at[n].alias("start"), (at[n] + F.length(h)).alias("stop"), h.alias("m"),
                F.right(gap[n], F.lit(CONTEXT)).alias("before"), F.left(gap[n + 1], F.lit(CONTEXT)).alias("after"),
            )

        spans[f"span{i}"] = F.transform(F.col(f"_hit{i}"), span).cast(f"array<{SPAN}>")
    return df.withColumns(spans).drop(*parts, *[f"_at{i}" for i in range(len(patterns))])


def luhn(digits: str) -> str:
    digit = f"cast(substring({digits}, length({digits}) - i + 1, 1) AS int)"
    doubled = f"cast(substring('0246813579', {digit} + 1, 1) AS int)"
    return f"aggregate(sequence(1, length({digits})), 0, (total, i) -> total + if(i % 2 = 0, {doubled}, {digit})) % 10 = 0"


def _checked(kind: str, span: str) -> str:
    """SQL condition that a base match must meet."""
    digits = f"regexp_replace({span}.m, '[^0-9]', '')"
    if kind == "ip":
        return f"{span}.m RLIKE {_raw(rf'^(?:{OCTET}[.]){{3}}{OCTET}$')}"
    if kind == "card":
        return f"if(length({digits}) BETWEEN 13 AND 19, {luhn(digits)}, false)"
    if kind == "phone":
        return f"length({digits}) BETWEEN 9 AND 15"
    return "true"


def found_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(*keep, base, proposed): spans per row, base ones by kind and place; written once."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    patterns = list(BASE.items()) + GENERATORS
    spans = with_spans(rows, patterns)
    base = [F.expr(f"filter(span{i}, s -> {_checked(kind, 's')})") for i, kind in enumerate(BASE)]
    proposed = [F.col(f"span{i}") for i in range(len(BASE), len(patterns))]
    return stored(spans.select(*keep, F.concat(*base).alias("base"), F.concat(*proposed).alias("proposed")))


# ---- features ------------------------------------------------------------------


def _edge(char: str) -> str:
    """Class of a neighbouring character: none or space, letter, digit, stop, bracket or quote, other."""
    return (
        f"""CASE WHEN {char} = '' OR {char} RLIKE r'\\s' THEN 0 WHEN {char} RLIKE r'\\p{{L}}' THEN 1 WHEN {char} RLIKE '[0-9]' THEN 2 """
        f"""WHEN {char} RLIKE '[.,;:!?]' THEN 3 WHEN {char} RLIKE r"[\\[\\](){{}}<>'`]" THEN 4 ELSE 5 END"""
    )


def features(m: str, before: str, after: str, kind: str) -> dict[str, str]:
    """SQL of small integer features of a span ``m`` of a kind (0-based)."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    runs = f"filter(split({m}, '[^0-9]+'), r -> r <> '')"
    cue = " ".join(f"WHEN {kind} = {k} THEN {before} RLIKE {_raw('(?i)' + CUES[name])}" for k, name in enumerate(KINDS))
    return {
        "digits": f"least(length({digits}), 20)",
        "runs": f"least(size({runs}), 8)",
        "longest": f"least(coalesce(array_max(transform({runs}, r -> length(r))), 0), 20)",
        "seps": f"least(length(regexp_replace({m}, '[0-9A-Za-z]', '')), 9)",
        "letters": f"least(length(regexp_replace({m}, '[^A-Za-z]', '')), 9)",
        "luhn": f"cast(if(length({digits}) BETWEEN 13 AND 19, {luhn(digits)}, false) AS int)",
        "varied": f"least(size(array_distinct(split({digits}, ''))), 5)",
        "octets": f"cast(size({runs}) = 4 AND forall({runs}, r -> r RLIKE {_raw(f'^{OCTET}$')}) AS int)",
        "prefix": f"CASE WHEN {m} RLIKE '^[+]' THEN 2 WHEN {m} RLIKE '^00' THEN 1 ELSE 0 END",
        "paren": f"cast({m} RLIKE '[(]' AS int)",
        "dated": f"cast({m} RLIKE r'(?:19|20)[0-9]{{2}}[-/. ][01]?[0-9][-/. ][0-3]?[0-9]' AS int)",
        "at_sign": f"CASE WHEN {m} RLIKE '@' THEN 2 WHEN {m} RLIKE '(?i)at' THEN 1 ELSE 0 END",
        "tail": f"least(length(regexp_extract({m}, '([A-Za-z]*)$', 1)), 8)",
        "edge_before": _edge(f"right({before}, 1)"),
        "edge_after": _edge(f"left({after}, 1)"),
        "more_before": f"cast({before} RLIKE '[0-9][-./ ]?$' AS int)",
        "more_after": f"cast({after} RLIKE '^[-./ ]?[0-9]' AS int)",
        "cue": f"cast(CASE {cue} ELSE false END AS int)",
    }


NAMES = list(features("m", "b", "a", "k"))


def rewritings() -> str:
    """SQL array of (label, text) made from a base span ``m`` of kind ``k``: other formats and broken copies."""
    digits = "regexp_replace(m, '[^0-9]', '')"
    last = f"try_cast(right({digits}, 1) AS int)"
    wrong = f"concat(left({digits}, length({digits}) - 1), ({last} + 1) % 10)"
    tail = f"substring({digits}, 2)"  # a number without its first digit, as people write it at home

    def fours(d: str, sep: str) -> str:
        return f"regexp_replace({d}, '([0-9]{{4}})(?=[0-9])', '$1{sep}')"

    def threes(d: str, sep: str) -> str:
        return f"regexp_replace({d}, '^([0-9]*)([0-9]{{3}})([0-9]{{4}})$', '$1{sep}$2{sep}$3')"

    made = {
        "email": (
            ["m", "replace(m, '@', ' [at] ')", "replace(replace(m, '@', '(at)'), '.', '(dot)')", "replace(replace(m, '@', ' at '), '.', ' dot ')", "replace(m, '@', ' @ ')"],
            ["regexp_replace(m, '@.*$', '@local')", "regexp_replace(m, '[.][A-Za-z]+$', '.7')", "regexp_replace(m, '[A-Za-z]+$', 'x')", "'look at this dot'"],
        ),
        "ip": (
            ["m", "replace(m, '.', '[.]')", "replace(m, '.', ' . ')", "replace(m, '.', '(.)')"],
            ["regexp_replace(m, '[0-9]+$', '999')", "regexp_replace(m, '^[0-9]+', '640')", "regexp_replace(replace(m, '.', '[.]'), '[0-9]+$', '721')"],
        ),
        "card": (
            [digits, *[fours(digits, s) for s in (" ", "-", ".", "/")]],
            [wrong, *[fours(wrong, s) for s in (" ", "-", ".", "/")], f"left({digits}, 12)", f"repeat('0', length({digits}))"],
        ),
        "phone": (
            ["m", f"concat('00', {threes(digits, '-')})", threes(tail, "-"), threes(tail, "."), threes(tail, " "),
             f"regexp_replace({threes(tail, '-')}, '^([0-9]+)-', '($1) ')"],
            [tail, f"left({tail}, 8)", f"concat('2019-05-17 ', left({tail}, 4))", f"concat({digits}, '12345678')", threes(f"left({tail}, 8)", " "),
             f"concat(left({tail}, 3), '.', substring({tail}, 4))"],
        ),
    }
    cases = []
    for k, kind in enumerate(KINDS):
        good, bad = made[kind]
        rows = [f"struct(1 AS label, {x} AS m)" for x in good] + [f"struct(0 AS label, {x} AS m)" for x in bad]
        cases.append(f"WHEN {k} THEN array({', '.join(rows)})")
    return f"CASE k {' '.join(cases)} END"


def lessons(found: DataFrame) -> DataFrame:
    """(k, held, label, features..., n): examples and counter-examples, equal ones counted; written once."""
    spans = found.select(F.explode("base").alias("s")).select("s.*").filter(F.length("m") <= LONGEST_LESSON)
    held = "pmod(xxhash64(m), 3) = 0 AS held"
    taught = spans.selectExpr("k", held, f"explode({rewritings()}) AS made", "before", "after").selectExpr(
        "k", "held", "made.label AS label", "made.m AS m", "before", "after"
    )
    # the first twelve digits of a card are no phone number
    digits = "regexp_replace(m, '[^0-9]', '')"
    parted = spans.filter("k = 2").selectExpr("m", "before", f"explode(transform(array('.', ' ', '-'), x -> regexp_replace({digits}, '([0-9]{{4}})(?=[0-9])', concat('$1', x)))) AS fours")
    parted = parted.selectExpr("3 AS k", held, "0 AS label", "left(fours, 14) AS m", "before", "substring(fours, 15) AS after")
    proposed = found.select(F.explode("proposed").alias("s")).select("s.*")
    own = features("m", "before", "after", "k")
    refuted = proposed.filter(f"(k = 1 AND {own['octets']} = 0) OR (k = 2 AND {own['luhn']} = 0)").selectExpr(
        "k", held, "0 AS label", "m", "before", "after"
    )
    rows = taught.unionByName(parted).unionByName(refuted).selectExpr("k", "held", "label", *[f"cast({own[n]} AS int) AS {n}" for n in NAMES])
    counted = rows.groupBy("k", "held", "label", *NAMES).agg(F.count(F.lit(1)).alias("n"))
    return stored(counted)


# ---- boosting ------------------------------------------------------------------


def tree_sql(tree, at: str = "") -> str:
    """A leaf value, or (feature, largest value on the left, left tree, right tree), as SQL; ``at`` prefixes features."""
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    name, value, low, high = tree
    return f"if({at}{name} <= {value}, {tree_sql(low, at)}, {tree_sql(high, at)})"


def score_sql(trees: list, at: str = "") -> str:
    return " + ".join([f"{0.0!r}D", *[tree_sql(t, at) for t in trees]])


def _by_kind(models: dict[int, str]) -> str:
    return f"CASE k {' '.join(f'WHEN {k} THEN {sql}' for k, sql in models.items())} ELSE 0 END" if models else "0"


def best_split(sums: dict[str, dict[int, tuple[int, int]]]):
    """(gain, feature, value) of the best cut of a node, from gradient and curvature sums per feature value; None without one."""
    best = None
    for name in NAMES:
        held = sorted(sums.get(name, {}).items())
        g, h = sum(v[0] for _, v in held), sum(v[1] for _, v in held)
        left_g = left_h = 0
        for value, (dg, dh) in held[:-1]:
            left_g, left_h = left_g + dg, left_h + dh

            def worth(x: int, y: int) -> float:
                return (x / GRAIN) ** 2 / (y / GRAIN + SHRINK)

            gain = worth(left_g, left_h) + worth(g - left_g, h - left_h) - worth(g, h)
            if gain > 1e-6 and (best is None or gain > best[0]):
                best = (gain, name, value)
    return best


def _sums(table: DataFrame, trees: dict[int, list], node: dict[int, str]) -> dict:
    """{(kind, node): {feature: {value: (gradients, curvatures)}}}, as whole numbers, so the order of rows cannot matter."""
    score = _by_kind({k: score_sql(t) for k, t in trees.items()})
    cells = ", ".join(f"struct('{n}' AS name, {n} AS value)" for n in NAMES)
    rows = table.selectExpr("k", f"{_by_kind(node)} AS node", "n", "label", f"1 / (1 + exp(-({score}))) AS p", f"explode(array({cells})) AS cell")
    sums = rows.groupBy("k", "node", "cell.name", "cell.value").agg(
        F.expr(f"sum(n * cast(round((label - p) * {GRAIN}) AS bigint))").alias("g"),
        F.expr(f"sum(n * cast(round(p * (1 - p) * {GRAIN}) AS bigint))").alias("h"),
    )
    out: dict = defaultdict(lambda: defaultdict(dict))
    for r in sums.collect():  # kinds x nodes x feature values, some thousand rows at most
        out[r["k"], r["node"]][r["name"]][r["value"]] = (r["g"], r["h"])
    return out


def _leaf(sums: dict) -> float:
    held = next(iter(sums.values()))
    g, h = sum(v[0] for v in held.values()), sum(v[1] for v in held.values())
    return round(LEARNING_RATE * (g / GRAIN) / (h / GRAIN + SHRINK), 6)


def fit(table: DataFrame) -> dict[int, list]:
    """Trees of two levels per kind; each level of all kinds is one aggregate."""
    both = table.groupBy("k").agg(F.count_distinct("label").alias("labels")).filter("labels = 2").collect()
    trees: dict[int, list] = {r["k"]: [] for r in sorted(both)}
    for _ in range(TREES if trees else 0):
        roots = {k: best_split(s) for (k, _), s in _sums(table, trees, {k: "0" for k in trees}).items() if k in trees}
        roots = {k: cut for k, cut in roots.items() if cut is not None}
        if not roots:
            break
        sides = _sums(table, trees, {k: f"if({name} <= {value}, 1, 2)" for k, (_, name, value) in roots.items()})
        grown = {}
        for k, (_, name, value) in roots.items():
            halves = []
            for side in (1, 2):
                split = best_split(sides[k, side])
                halves.append((k, side) if split is None else (split[1], split[2]))
            grown[k] = (name, value, *halves)
        leaves = _sums(table, trees, {k: _leaf_number(tree) for k, tree in grown.items()})
        for k, (name, value, low, high) in grown.items():
            sides_grown = []
            for side, half in ((1, low), (2, high)):
                if half == (k, side):
                    sides_grown.append(_leaf(sides[k, side]))
                else:
                    sides_grown.append((*half, _leaf(leaves[k, 2 * side + 1]), _leaf(leaves[k, 2 * side + 2])))
            trees[k].append((name, value, *sides_grown))
    return trees


def _leaf_number(tree) -> str:
    """SQL of the node (3 to 6) that a row reaches below the two halves of a tree in growth."""
    name, value, low, high = tree

    def half(side: int, cut) -> str:
        return f"if({cut[0]} <= {cut[1]}, {2 * side + 1}, {2 * side + 2})" if isinstance(cut[0], str) else f"{side}"

    return f"if({name} <= {value}, {half(1, low)}, {half(2, high)})"


def thresholds(table: DataFrame, trees: dict[int, list]) -> dict[int, float]:
    """Per kind, the least score (in thousandths of a probability) from which held-out precision is PRECISION; none: infinite."""
    score = _by_kind({k: score_sql(t) for k, t in trees.items()})
    rows = table.filter("held").selectExpr("k", f"cast(floor(1000 / (1 + exp(-({score})))) AS int) AS p", "label", "n")
    counted = rows.groupBy("k", "p").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right"))
    by_kind = defaultdict(list)
    for r in counted.collect():  # at most a thousand scores a kind
        by_kind[r["k"]].append((r["p"], r["n"], r["right"]))
    out = {}
    for k in trees:
        n = right = 0
        out[k] = math.inf
        for p, more, more_right in sorted(by_kind[k], reverse=True):
            n, right = n + more, right + more_right
            if right >= PRECISION * n and right > 0:
                out[k] = p / 1000
    return out


# ---- selection -----------------------------------------------------------------


def with_scores(found: DataFrame, trees: dict[int, list], floors: dict[int, float]) -> DataFrame:
    """Adds ``accepted``: proposals at or above the threshold of their kind, as marks."""
    usable = {k: t for k, t in trees.items() if math.isfinite(floors[k])}
    own = features("s.m", "s.before", "s.after", "s.k")
    cells = ", ".join(f"'{n}', cast({own[n]} AS int)" for n in NAMES)
    seen = f"transform(proposed, s -> named_struct('k', s.k, 'start', s.start, 'stop', s.stop, {cells}))"
    score = " ".join(f"WHEN {k} THEN {score_sql(t, 'c.')}" for k, t in usable.items())
    floor = " ".join(f"WHEN {k} THEN {floors[k]!r}D" for k in usable)
    if not usable:
        return found.withColumn("accepted", F.array().cast(f"array<{MARK}>"))
    scored = f"transform(seen, c -> struct(c.start AS start, -floor(1000 / (1 + exp(-(CASE c.k {score} ELSE -99D END)))) / 1000D AS rank, c.stop AS stop, c.k AS k))"
    kept = f"filter(scored, c -> -c.rank >= CASE c.k {floor} ELSE 2D END)"
    return found.withColumn("seen", F.expr(seen)).withColumn("scored", F.expr(scored)).withColumn(
        "accepted", F.expr(kept).cast(f"array<{MARK}>")
    )


def mark(x: Column, rank: float) -> Column:
    return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["stop"].alias("stop"), x["k"].alias("k"))


def with_added(df: DataFrame) -> DataFrame:
    """Adds ``added``: accepted marks that touch no base span and none another, from left to right.

    Of overlapping neighbours the better score stays, of equal ones the left one.
    """
    kept = f"array<{MARK}>"
    none = F.array().cast(kept)
    nowhere, far = (
        F.struct(F.lit(at).cast("bigint").alias("start"), F.lit(0.0).alias("rank"), F.lit(at).cast("bigint").alias("stop"), F.lit(0).alias("k"))
        for at in (0, 1 << 62)
    )
    together = F.array_sort(F.concat(F.transform("base", lambda s: mark(s, BASE_RANK)).cast(kept), F.col("accepted")))

    def better_before(last: Column, x: Column):
        """The state is the last mark, or the base span that reaches furthest."""
        stays = (x["rank"] == BASE_RANK) | (x["start"] >= last["stop"]) | (x["rank"] < last["rank"])
        reaches = ~stays | ((last["rank"] == BASE_RANK) & (last["stop"] > x["stop"]))
        return F.when(reaches, last).otherwise(x), F.when(stays, F.array(x)).otherwise(none)

    def better_behind(last: Column, x: Column):
        stays = (x["rank"] == BASE_RANK) | (x["stop"] <= last["start"]) | (x["rank"] <= last["rank"])
        reaches = ~stays | ((last["rank"] == BASE_RANK) & (last["start"] < x["start"]))
        return F.when(reaches, last).otherwise(x), F.when(stays, F.array(x)).otherwise(none)

    def leftmost(last: Column, x: Column):
        stays = x["start"] >= last["stop"]
        return F.when(stays, x).otherwise(last), F.when(stays & (x["rank"] != BASE_RANK), F.array(x)).otherwise(none)

    df = folded(df, "added", F.when(F.size("accepted") > 0, together).otherwise(none), nowhere, kept, better_before)
    df = folded(df, "added", F.reverse("added"), far, kept, better_behind)
    return folded(df, "added", F.reverse("added"), nowhere, kept, leftmost)


def personal_data(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, base, added), and text if asked for, per row of ``docs`` (doc_id, text): arrays of spans (k, start, stop, ...).

    ``k`` counts KINDS from 0; start and stop are code points, stop exclusive. Base spans are
    leftmost and non-overlapping per kind; matches that fail their check are dropped without a
    retry. Added spans overlap neither base spans nor one another.

    A null or empty text has no spans. Rows may repeat, share a doc_id or lack one; each returns a
    row. Very long texts and texts with very many spans are read whole. A kind without a single
    base span in the whole table has nothing to learn from, so nothing of it is added; an empty
    table gives an empty result.
    """
    keep = ["doc_id", "text"] if with_text else ["doc_id"]
    found = found_spans(documents(docs), keep)
    table = lessons(found)
    trees = fit(table.filter("NOT held"))
    scored = with_scores(found, trees, thresholds(table, trees))
    return with_added(scored).select(*keep, "base", "added")


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas, by kind and start."""
    plain = F.array_sort(F.transform(spans, lambda s: F.struct(s["k"].alias("k"), s["start"].alias("start"), s["stop"].alias("stop"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(plain, lambda s: F.concat_ws(":", names[s["k"]], s["start"], s["stop"])), ",")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); see personal_data."""
    found = personal_data(docs)

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["k"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")

    fields = "array<struct<k:int,start:bigint,stop:bigint>>"

    def places(name: str) -> Column:
        return F.transform(name, lambda s: F.struct(s["k"].alias("k"), s["start"].alias("start"), s["stop"].alias("stop"))).cast(fields)

    return found.select(
        "doc_id", *[count(k) for k in range(len(KINDS))],
        F.sha2(span_text(places("base")), 256).alias("base_sha256"),
        span_text(F.concat(places("base"), places("added"))).alias("spans"),
    )


def redacted(docs: DataFrame, fill: str = "[{}]") -> DataFrame:
    """(doc_id, text) with every span replaced by ``fill`` of its kind; a null text becomes an empty one.

    Overlapping spans of different kinds are replaced together, under the kind of the first.
    """
    kept = f"array<{MARK}>"

    def merged(growing: Column, x: Column):
        """The state is the mark in growth; a mark that starts behind its end pushes it out."""
        joins = x["start"] < growing["stop"]
        grown = F.struct(growing["start"].alias("start"), F.lit(0.0).alias("rank"), F.greatest(growing["stop"], x["stop"]).alias("stop"), growing["k"].alias("k"))
        return F.when(joins, grown).otherwise(x), F.when(joins, F.array().cast(kept)).otherwise(F.array(growing))

    def at(place: Column) -> Column:
        place = place.cast("bigint")
        return F.struct(place.alias("start"), F.lit(0.0).alias("rank"), place.alias("stop"), F.lit(0).alias("k"))

    df = personal_data(docs, with_text=True).withColumn("text", F.coalesce("text", F.lit("")))
    marks = F.concat(*[F.transform(c, lambda s: mark(s, 0.0)).cast(kept) for c in ("base", "added")])
    # an empty mark at each end: the first opens the fold, the last pushes the last span out
    df = folded(df, "marks", F.concat(F.array_sort(marks), F.array(at(F.length("text")))), at(F.lit(0)), kept, merged)
    df = df.withColumn("_chunks", chunked("marks"))

    def stretch(c: Column, i: Column) -> Column:
        """A run of marks with its own part of the text."""
        low = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.element_at(F.col("_chunks")[F.greatest(i - 1, F.lit(0))], -1)["stop"])
        text = F.substring("text", (low + 1).cast("int"), (F.element_at(c, -1)["stop"] - low).cast("int"))
        return F.struct(low.alias("low"), text.alias("text"), c.alias("marks"))

    fills = F.array(*[F.lit(fill.format(k)) for k in KINDS])

    def cleared(run: Column) -> Column:
        def piece(x: Column, j: Column) -> Column:
            since = F.when(j == 0, run["low"]).otherwise(run["marks"][F.greatest(j - 1, F.lit(0))]["stop"])
            before = F.substring(run["text"], (since - run["low"] + 1).cast("int"), (x["start"] - since).cast("int"))
            return F.concat(before, F.when(x["stop"] > x["start"], fills[x["k"]]).otherwise(F.lit("")))

        return F.array_join(F.transform(run["marks"], piece), "")

    df = df.withColumn("_runs", F.transform("_chunks", stretch))
    last = F.coalesce(F.element_at("marks", -1)["stop"], F.lit(0))
    rest = F.substring("text", (last + 1).cast("int"), F.length("text"))
    return df.select("doc_id", F.concat(F.array_join(F.transform("_runs", cleared), ""), rest).alias("text"))
