"""Personal data: patterns propose spans, checksums confirm them, context words set the score.

Only built-in column functions are used.  A span's place comes from the pieces that
split() leaves between matches: both split() and regexp_extract_all() walk the same
leftmost, non-overlapping matches.  Account numbers are proposed from every place where
one can start, and cut to the part that the check confirms.  Context are the characters
before and behind a span, whatever stands there; a context word counts as a whole word only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that the method adds to the base: account numbers with a mod-97 check, shorter cards near a context word.
ADDED_KINDS = ("iban", "card_short")

# Every pattern below finds what the contract's plain pattern finds.  A start inside a run
# of the pattern's own characters is ruled out by a look-behind (the run's first place
# would have matched), and repeated parts never give characters back, so a long run of
# digits or letters costs linear time and no recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Whole runs of 13 to 19 digits; runs of other lengths fail the contract's digit count anyway.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
}
#: A cheap test that a text can hold the kind at all.
HINTS: dict[str, Callable[[Column], Column]] = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
}
CONTEXT = {
    "email": ("mail", "mails", "email", "emails", "contact", "write"),
    "ip": ("ip", "ips", "host", "hosts", "server", "servers", "address", "addresses"),
    "card": ("card", "cards", "visa", "mastercard", "credit", "payment", "payments"),
    "phone": ("phone", "phones", "telephone", "call", "tel", "mobile"),
    "iban": ("iban", "ibans", "account", "accounts", "bank"),
    "card_short": ("card", "cards", "amex", "credit", "payment", "payments"),
}
CONTEXT_CHARS = 40
#: Characters of the pieces into which a text is cut to look its contexts up.
PIECE_CHARS = 1024
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of an account number by country (registry of ISO 13616).
ACCOUNT_CHARS = {
    k: int(n)
    for n, codes in (
        (15, "NO"), (16, "BE"), (18, "DK FI FK FO GL NL SD"), (19, "MK SI"), (20, "AT BA EE KZ LT LU MN XK"), (21, "CH HR LI LV"),
        (22, "BG BH CR DE GB GE IE ME RS VA"), (23, "AE GI IL IQ OM SO TL"), (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"),
        (27, "BI DJ FR GR IT MC MR SM"), (28, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (29, "BR EG PS QA UA"), (30, "JO KW MU YE"), (31, "MT SC"), (32, "LC"), (33, "RU"),
    )
    for k in codes.split()
}
SPAN = "struct<s:int,e:int,digits:int>"


def _chars(text: Column, count: Column) -> Column:
    """The places 1..count, or none."""
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        double = (n - i) % 2 == 1
        return total + F.when(double & (d > 4), 2 * d - 9).when(double, 2 * d).otherwise(d)

    return F.aggregate(_chars(digits, n), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number of at most 34 capitals and digits leaves 1 modulo 97 once its first four characters go last and letters count from 10."""
    moved = once(account, lambda a: F.concat(F.substring(a, F.lit(5), F.length(a)), F.substring(a, 1, 4)))
    for k, letter in enumerate(CAPITALS):
        moved = F.replace(moved, F.lit(letter), F.lit(str(10 + k)))
    half = 34  # digits that one decimal number holds
    powers = F.array(*(F.lit(pow(10, k, 97)) for k in range(half + 1)))
    rest = lambda digits: F.coalesce((digits.try_cast(f"decimal({half},0)") % 97).cast("int"), F.lit(0))

    def check(d: Column) -> Column:
        behind = F.substring(d, F.lit(half + 1), F.lit(half))
        return (rest(F.substring(d, 1, half)) * F.element_at(powers, F.length(behind) + 1) + rest(behind)) % 97 == 1

    return once(moved, check)


def _octet(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def _digits(match: Column) -> Column:
    return F.translate(match, "+ ().-", "")


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), _octet),
    "card": lambda m: luhn(_digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
    "iban": lambda m: mod97(F.translate(m, " ", "")),
}


def context_pattern(kind: str) -> str:
    """A context word of the kind between characters that are no letters or digits."""
    return f"[^a-z0-9](?:{'|'.join(CONTEXT[kind])})[^a-z0-9]"


def score_of(kind: str, near: Column) -> Column:
    """0.6, or 0.95 where a context word of the kind stands in the characters around the span."""
    return F.when(near.rlike(context_pattern(kind)), 0.95).otherwise(0.6)


def around(pieces: Column, span: Column) -> Column:
    """The CONTEXT_CHARS characters before and behind a span and one more each way, A-Z in lower case; blanks stand for the text's ends and the span.

    pieces: the text in pieces of PIECE_CHARS characters.
    """
    reach = CONTEXT_CHARS + 1

    def cut(start: Column, length: Column) -> Column:
        k = F.floor(start / PIECE_CHARS).cast("int")
        two = F.concat(*(F.coalesce(F.try_element_at(pieces, k + n), F.lit("")) for n in (1, 2)))
        return F.substring(two, start - k * PIECE_CHARS + 1, length)

    first = F.greatest(span["s"] - reach, F.lit(0))
    before = F.concat(F.when(span["s"] <= CONTEXT_CHARS, " ").otherwise(""), cut(first, span["s"] - first), F.lit(" "))
    behind = F.rpad(cut(span["e"], F.lit(reach)), reach, " ")
    return F.translate(F.concat(before, F.lit(" "), behind), CAPITALS, SMALL)


def scored(spans: Column, pieces: Column, kind: str) -> Column:
    """spans with a score each."""

    def one(x: Column) -> Column:
        near = around(pieces, x)
        score = F.when(x["digits"] < 16, score_of("card_short", near)).otherwise(score_of("card", near)) if kind == "card" else score_of(kind, near)
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), x["digits"].alias("digits"), score.alias("score"))

    return F.transform(spans, one)


def fold(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Walk over an array with a state; step gives (state, array of what is added to the result).

    What is found is added up in chunks of the square root of the length, so that the growing
    result is not copied at every item.
    """
    nothing = F.array().cast(f"array<{SPAN}>")

    def inner(acc: Column, x: Column) -> Column:
        def joined(moved: Column) -> Column:
            return F.struct(moved["state"].alias("state"), F.when(F.size(moved["added"]) > 0, F.concat(acc["found"], moved["added"])).otherwise(acc["found"]).alias("found"))

        return once(step(acc["state"], x), joined)

    def outer(acc: Column, chunk: Column) -> Column:
        begun = F.struct(acc["state"].alias("state"), nothing.alias("found"))
        return F.aggregate(chunk, begun, inner, lambda a: F.struct(a["state"].alias("state"), F.concat(acc["found"], a["found"]).alias("found")))

    def walk(once: Column) -> Column:
        n = F.size(once)
        width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
        chunks = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1, width)).otherwise(F.array().cast("array<int>")), lambda k: F.slice(once, k + 1, width))
        return F.aggregate(chunks, F.struct(start.alias("state"), nothing.alias("found")), outer, lambda acc: acc["found"])

    return once(items, walk)  # the items are found once, not once a chunk


def account_length(match: Column) -> Column:
    """Characters of the confirmed number at the start of a candidate, or 0.

    The length of its country counts first, then the whole candidate, then, for codes that
    the registry doesn't have, the longest part that ends before a blank.
    """
    bare = lambda t: F.translate(t, " ", "")
    part = lambda i: F.substring(match, F.lit(1), i)
    lengths = F.create_map(*(F.lit(x) for kv in ACCOUNT_CHARS.items() for x in kv))
    places = F.sequence(F.lit(15), F.greatest(F.length(match), F.lit(15)))

    def confirmed(x: Column) -> Column:
        number, due = x["number"], x["due"]
        # Where the country's length is confirmed, and only there, its end is looked for among the blanks.
        at_due = F.try_element_at(F.filter(places, lambda i: F.length(bare(part(i))) == due), F.lit(1))
        fixed = F.when((F.length(number) >= due) & mod97(F.substring(number, F.lit(1), due)), at_due)
        ends = lambda i: (F.substring(match, i + 1, F.lit(1)) == " ") & (F.length(bare(part(i))) >= 15)
        other = F.when(due.isNull() & F.contains(match, F.lit(" ")), F.array_max(F.filter(F.filter(places, ends), lambda i: mod97(bare(part(i))))))
        return F.coalesce(fixed, F.when(mod97(number), F.length(match)), other, F.lit(0))

    return once(F.struct(bare(match).alias("number"), F.try_element_at(lengths, F.substring(match, 1, 2)).alias("due")), confirmed)


def find_accounts(text: Column) -> Column:
    """As find_spans, for account numbers: from every start behind the last confirmed number."""
    starts = f"(?={PATTERNS['iban']})"
    found = F.regexp_extract_all(text, F.lit(f"(?=({PATTERNS['iban']}))"), F.lit(1))
    pieces = F.split(text, starts, -1)
    pieces = F.when(F.size(pieces) > F.size(found), pieces).otherwise(F.concat(F.array(F.lit("")), pieces))  # no piece stands before a start at 0
    nothing = F.array().cast(f"array<{SPAN}>")

    def walk(at: Column, x: Column) -> Column:
        match, before = x["m"], x["p"]
        start = at["pos"] + F.length(before)
        free = at["skip"] <= F.length(before)
        n = F.when(free & match.isNotNull(), account_length(match)).otherwise(0)

        def placed(n: Column) -> Column:
            span = F.array(F.struct(start.cast("int").alias("s"), (start + n).cast("int").alias("e"), F.lit(0).alias("digits")).cast(SPAN))
            skip = F.when(n > 0, n).when(free, 0).otherwise(at["skip"] - F.length(before))
            return F.struct(F.struct(start.cast("int").alias("pos"), skip.cast("int").alias("skip")).alias("state"), F.when(n > 0, span).otherwise(nothing).alias("added"))

        return once(n, placed)

    first = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("skip"))
    return F.when(HINTS["iban"](text), fold(F.arrays_zip(found.alias("m"), pieces.alias("p")), first, walk)).otherwise(nothing)


def find_spans(text: Column, kind: str) -> Column:
    """array of (s, e, digits) of the confirmed matches of a kind, in order of place; code points, end exclusive."""
    if kind == "iban":
        return find_accounts(text)
    pattern, valid = PATTERNS[kind], CHECKS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("p"))
    nothing = F.array().cast(f"array<{SPAN}>")

    def walk(at: Column, x: Column) -> Column:
        match, before = x["m"], x["p"]
        start = at["pos"] + F.length(before)
        end = start + F.coalesce(F.length(match), F.lit(0))
        digits = F.length(_digits(match)) if kind == "card" else F.lit(0)
        span = F.array(F.struct(start.cast("int").alias("s"), end.cast("int").alias("e"), digits.alias("digits")).cast(SPAN))
        return F.struct(F.struct(end.cast("int").alias("pos")).alias("state"), F.when(match.isNotNull() & valid(match), span).otherwise(nothing).alias("added"))

    return F.when(HINTS[kind](text), fold(parts, F.struct(F.lit(0).alias("pos")), walk)).otherwise(nothing)


def personal_data(docs: DataFrame, min_score: float = 0.9) -> DataFrame:
    """doc_id, text and one span array (s, e, digits, score) per kind of every document.

    card holds confirmed runs of 16 to 19 digits; card_short those of 13 to 15 whose score
    reaches min_score (a checksum alone is weak evidence for so short a run).  Base kinds
    are kept whatever their score.  Null and empty texts have no span; rows are judged one
    by one, so null ids, repeated rows and other columns change nothing.
    """
    spans = docs.select("doc_id", "text", *(find_spans(F.coalesce("text", F.lit("")), k).alias(f"__{k}") for k in PATTERNS))
    found = sum((F.size(f"__{k}") for k in PATTERNS), F.lit(0))
    spans = spans.withColumn("__pieces", F.when(found > 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))))
    spans = spans.select("doc_id", "text", *(scored(F.col(f"__{k}"), F.col("__pieces"), k).alias(f"__{k}") for k in PATTERNS))
    return spans.select(
        "doc_id",
        "text",
        *(F.col(f"__{k}").alias(k) for k in ("email", "ip", "phone", "iban")),
        F.filter("__card", lambda x: x["digits"] >= 16).alias("card"),
        F.filter("__card", lambda x: (x["digits"] < 16) & (x["score"] >= min_score)).alias("card_short"),
    )


def _listed(kinds: tuple[str, ...]) -> Column:
    def named(kind: str) -> Column:
        return F.transform(kind, lambda x: F.concat(F.lit(f"{kind}:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))

    return F.array_join(F.concat(*map(named, kinds)), ",")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, all spans and their scores, per document."""
    found = personal_data(docs)
    kinds = BASE_KINDS + ADDED_KINDS
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(_listed(BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        _listed(kinds).alias("spans"),
        F.array_join(F.concat(*(F.transform(k, lambda x: x["score"].cast("string")) for k in kinds)), ",").alias("scores"),
    )


def _sql_spans(kind: str, pattern: str, valid: str) -> str:
    """A DuckDB list of {m, p, s, e} of the matches that hold, in order."""
    return f"""
      list_filter(list_transform(range(1, len(m_{kind}) + 1), lambda i: {{
        'm': m_{kind}[i], 'p': p_{kind}[i],
        's': CAST(list_sum(list_transform(p_{kind}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m_{kind}[1:i-1], lambda x: length(x))), 0) AS BIGINT)}}),
        lambda v: {valid}) AS f_{kind}"""


def _sql_listed(kind: str, of: str) -> str:
    return f"list_transform({of}, lambda x: '{kind}:' || x.s || ':' || (x.s + length(x.m)))"


def _sql_near(x: str) -> str:
    """The characters around a span x of the text t, as around() gives them."""
    reach, end = CONTEXT_CHARS + 1, f"({x}.s + length({x}.m))"
    before = f"CASE WHEN {x}.s <= {CONTEXT_CHARS} THEN ' ' ELSE '' END || substring(t, greatest({x}.s - {reach}, 0) + 1, {x}.s - greatest({x}.s - {reach}, 0))"
    return f"translate({before} || '  ' || rpad(substring(t, {end} + 1, {reach}), {reach}, ' '), '{CAPITALS}', '{SMALL}')"


def _sql_scores(kind: str, of: str) -> str:
    return f"list_transform({of}, lambda x: CASE WHEN regexp_matches({_sql_near('x')}, '{context_pattern(kind)}') THEN '0.95' ELSE '0.6' END)"


def oracle_sql() -> str:
    """The digest in DuckDB, from the contract's plain patterns."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}",
    }
    digits = "translate(v.m, '+ ().-', '')"
    luhn_sum = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda j: CASE WHEN (length({digits}) - j) % 2 = 1 "
        f"THEN CASE WHEN CAST({digits}[j] AS INT) > 4 THEN 2 * CAST({digits}[j] AS INT) - 9 ELSE 2 * CAST({digits}[j] AS INT) END ELSE CAST({digits}[j] AS INT) END)) % 10 = 0"
    )
    bare = "replace(v.m, ' ', '')"
    moved = f"({bare}[5:] || {bare}[1:4])"
    mod = (
        f"list_reduce(list_transform(range(1, length({moved}) + 1), lambda j: CAST(CASE WHEN ascii({moved}[j]) < 65 THEN ascii({moved}[j]) - 48 ELSE ascii({moved}[j]) - 55 END AS BIGINT)), "
        "lambda a, b: (CASE WHEN b < 10 THEN a * 10 + b ELSE a * 100 + b END) % 97) = 1"
    )
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(v.m, '.'), lambda o: length(ltrim(o, '0')) > 3 OR coalesce(TRY_CAST(ltrim(o, '0') AS INT), 0) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn_sum}",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
        "iban": mod,
    }
    quoted = {k: p.replace("'", "''") for k, p in plain.items()}
    pieces = ", ".join(f"regexp_extract_all(t, '{p}') AS m_{k}, string_split_regex(t, '{p}') AS p_{k}" for k, p in quoted.items())
    spans = ", ".join(_sql_spans(k, p, valid[k]) for k, p in quoted.items())
    of = {k: f"f_{k}" for k in ("email", "ip", "phone", "iban")}
    of["card"] = "list_filter(f_card, lambda c: length(translate(c.m, '+ ().-', '')) >= 16)"
    short = f"regexp_matches({_sql_near('c')}, '{context_pattern('card_short')}')"
    of["card_short"] = f"list_filter(f_card, lambda c: length(translate(c.m, '+ ().-', '')) < 16 AND ({short}))"
    both = BASE_KINDS + ADDED_KINDS
    listed = lambda kinds: "array_to_string(" + " || ".join(_sql_listed(k, of[k]) for k in kinds) + ", ',')"
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    pieces AS (SELECT doc_id, t, {pieces} FROM texts),
    found AS (SELECT doc_id, t, {spans} FROM pieces)
    SELECT doc_id, {", ".join(f"CAST(len({of[k]}) AS BIGINT) AS n_{k}" for k in BASE_KINDS)},
      sha256({listed(BASE_KINDS)}) AS base_sha256, {listed(both)} AS spans,
      array_to_string({" || ".join(_sql_scores(k, of[k]) for k in both)}, ',') AS scores
    FROM found"""
