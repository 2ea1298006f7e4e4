"""Personal data: weak labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Everything on the corpus is built from DataFrame functions.  Only the table of vote patterns (a bounded number of
rows, whatever the corpus) reaches the driver, where expectation-maximisation runs on it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapulse.llm._text import carried
from terrapulse.session import materialise

#: Base kinds in the contract's order, then kinds that only the classifier adds.
BASE = ("email", "ip", "card", "phone")
EXTRA = ("local", "ssn", "name", "secret")
KINDS = BASE + EXTRA
VOTES = ("form", "gazetteer", "cue", "against", "edge")

#: First names, titles, top-level domains, dialling codes, cue words.
FIRST_NAMES = "Anna Carlos Carmen David Elena Emma Hans Heinrich Jack James Jean John Jose Juan Julia Karl Laura Linda Louis Lucia Maria Marie Mark Mary Michael Paul Peter Pierre Robert Sarah Sophie Thomas William".split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Mme Sr Sra".split()
TOP_LEVEL = "com org net edu gov io de fr es uk eu info".split()
DIALLING = "1 7 20 27 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 91".split()
CUES = "address call card contact credit email e-mail fax mail mobile phone reach ssn social tel telephone write correo teléfono téléphone adresse telefon api auth bearer credential key pass passwd password secret token".split()
#: How the keys of well-known issuers start.
KEY_HEADS = "AKIA ASIA AIza eyJ ghp_ gho_ github_pat_ glpat- hf_ npm_ pypi- rk_live_ sk- sk_live_ xoxb- xoxp- ya29".split()
AGAINST = "article build chapter doi isbn issue license order page release section version vol".split()

#: The contract's patterns, with possessive groups so that very long runs need no backtracking stack, and an anchor so
#: that a run of address characters is tried once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){2}\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local": r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z/+_-]*+[0-9])(?=[0-9/+_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+(?![A-Za-z0-9+/_-])",
    "name": r"\b(?:(?:" + "|".join(TITLES) + r")\.? |(?=(?:" + "|".join(FIRST_NAMES) + r") ))[A-ZÀ-Þ][a-zß-ÿ]+(?: [A-ZÀ-Þ][a-zß-ÿ]+)?",
}
EM_ROUNDS = 30


def _guard(kind: str, text: Column) -> Column:
    """A cheap test that a text without this can't hold the kind."""
    if kind == "email":
        return text.contains("@")
    if kind == "phone":
        return text.contains("+")
    return F.lit(True) if kind == "name" else text.rlike("[0-9]")


def _matches(kind: str, text: Column) -> Column:
    """Array of (kind, start, end, s, before): positions are sums of the lengths of matches and of what lies between."""
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,s:string,before:string>>")
    parts = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("p"), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("m"))
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        found = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["m"].alias("s"), F.lower(F.right(x["p"], F.lit(40))).alias("before"))
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.array_append(acc["out"], found).alias("out")))

    return F.when(_guard(kind, text), F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(empty)


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, F.lit(1))
    return (out if no is None else out.when(no, F.lit(-1))).otherwise(F.lit(0))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def passes(kind: Column, s: Column) -> Column:
    """The contract's check of a base match; candidates of other kinds have checks of their own."""
    d = _digits(s)
    octets = F.forall(F.split(s, "\\."), lambda p: p.rlike("^0*([0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", octets)
        .when(kind == "card", F.length(d).between(13, 19) & F.call_function("luhn_check", d))
        .when(kind == "phone", F.length(d).between(9, 15))
        .when(kind == "ssn", ~s.rlike("^(000|666|9)") & ~s.rlike("-00-|-0000$"))
        .when(kind == "secret", F.size(F.array_distinct(F.split(s, ""))) >= 10)
        .otherwise(F.lit(True))
    )


def _labelled(x: Column) -> Column:
    """A candidate with its votes: 1 for personal data, -1 against, 0 abstains."""
    kind, s, before = x["kind"], x["s"], x["before"]
    ok = passes(kind, s)
    gazetteer = (
        F.when(kind == "email", _vote(F.lower(F.regexp_extract(s, r"\.([^.]*)$", 1)).isin(TOP_LEVEL)))
        .when(kind == "ip", _vote(~s.rlike(r"^(0|127|255)\."), s.rlike(r"^(0|127|255)\.")))
        .when(kind == "card", _vote(s.rlike("^(4|5[1-5]|3[47]|6011|65|35)"), F.lit(True)))
        .when(kind == "phone", _vote(s.rlike(r"^\+(" + "|".join(DIALLING) + ")"), F.lit(True)))
        .when(kind == "local", _vote(s.rlike(r"^\(?[2-9]"), F.lit(True)))
        .when(kind == "secret", _vote(s.rlike("^(" + "|".join(KEY_HEADS) + ")") | s.rlike("^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"), s.rlike("^[A-Za-z]+[-/_][A-Za-z/_-]+[0-9]{1,4}$")))
        .when(kind == "name", _vote(s.rlike("^([A-Za-z]+\\.? )?(" + "|".join(FIRST_NAMES) + r")\b")))
        .otherwise(F.lit(0))
    )
    return F.struct(
        kind.alias("kind"),
        x["start"].alias("start"),
        x["end"].alias("end"),
        ok.alias("ok"),
        _vote(ok & (kind != "name"), ~ok).alias("form"),
        gazetteer.alias("gazetteer"),
        _vote(before.rlike(r"(?<!\p{L})(" + "|".join(CUES) + r")(?!\p{L})")).alias("cue"),
        (-_vote(before.rlike(r"(?<!\p{L})(" + "|".join(AGAINST) + r")(?!\p{L})"))).alias("against"),
        _vote(~before.rlike(r"[\p{L}0-9]$"), F.lit(True)).alias("edge"),
        F.least(F.lit(40), F.length(s)).alias("size"),
    )


def candidates(docs: DataFrame, *, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id``, the columns in ``carry``, and ``spans``, all candidates with their votes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", *carry, *[_matches(k, text).alias(f"_{k}") for k in KINDS])
    return found.select("doc_id", *carry, F.transform(F.concat(*[F.col(f"_{k}") for k in KINDS]), _labelled).alias("spans"))


@dataclass
class SpanModel:
    reliability: dict[str, dict[int, tuple[float, float]]]
    intercept: float
    weights: list[float]

    def probability(self, x: Column) -> Column:
        z = F.lit(self.intercept)
        for w, f in zip(self.weights, features(x), strict=True):
            z = z + F.lit(float(w)) * f
        return 1.0 / (1.0 + F.exp(-z))


def features(x) -> list[Column]:
    """Inputs of the classifier: the votes, the kind, the length."""
    return [x[v].cast("double") for v in VOTES] + [(x["kind"] == k).cast("double") for k in KINDS] + [x["size"] / 40.0]


def expectation_maximisation(patterns: list[dict], rounds: int = EM_ROUNDS) -> tuple[dict, list[float]]:
    """Reliability of each labeler, P(vote | personal) and P(vote | not), and each pattern's posterior.

    ``patterns`` has rows with ``kind``, the votes and their count ``n``.  The prior is per kind; counts are smoothed
    by one.  It starts from the sum of the votes.
    """
    posterior = [1 / (1 + math.exp(-sum(p[v] for v in VOTES))) for p in patterns]
    table: dict = {}
    for _ in range(rounds):
        prior: dict[str, list[float]] = {}
        table = {v: {k: [1.0, 1.0] for k in (-1, 0, 1)} for v in VOTES}
        for p, q in zip(patterns, posterior, strict=True):
            for y, w in ((0, q * p["n"]), (1, (1 - q) * p["n"])):
                prior.setdefault(p["kind"], [1.0, 1.0])[y] += w
                for v in VOTES:
                    table[v][p[v]][y] += w
        sums = {v: [sum(table[v][k][y] for k in table[v]) for y in (0, 1)] for v in VOTES}
        posterior = []
        for p in patterns:
            a = math.log(prior[p["kind"]][0] / prior[p["kind"]][1])
            a += sum(math.log(table[v][p[v]][0] / sums[v][0]) - math.log(table[v][p[v]][1] / sums[v][1]) for v in VOTES)
            posterior.append(1 / (1 + math.exp(-max(-50.0, min(50.0, a)))))
        table = {v: {k: (table[v][k][0] / sums[v][0], table[v][k][1] / sums[v][1]) for k in table[v]} for v in VOTES}
    return table, posterior


def fit(found: DataFrame) -> SpanModel | None:
    """Estimate the labelers' reliabilities and train the span classifier on the posteriors; None without candidates."""
    x = F.col("x")
    patterns = found.select(F.explode("spans").alias("x")).groupBy(x["kind"].alias("kind"), *[x[v].alias(v) for v in VOTES], x["size"].alias("size")).agg(F.count(F.lit(1)).alias("n"))
    rows = [r.asDict() for r in patterns.orderBy(*patterns.columns).collect()]
    if not rows:
        return None
    reliability, posterior = expectation_maximisation(rows)
    soft = [(*[r[c] for c in ("kind", *VOTES, "size")], float(y), r["n"] * (q if y else 1 - q) + 1e-9) for r, q in zip(rows, posterior, strict=True) for y in (0, 1)]
    names = ["kind", *VOTES, "size", "label", "weight"]
    table = found.sparkSession.createDataFrame(soft, "kind string, " + ", ".join(f"{v} int" for v in VOTES) + ", size int, label double, weight double").coalesce(1)
    table = table.select(array_to_vector(F.array(*features({c: F.col(c) for c in names}))).alias("features"), "label", "weight")
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(table)
    return SpanModel(reliability, float(model.intercept), [float(w) for w in model.coefficients])


def find_pii(docs: DataFrame, *, threshold: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """Personal data in whole texts.

    Returns per row: ``doc_id``, the columns in ``carry``, ``base`` and ``added``: arrays of (kind, start, end), in
    order of kind and start, in code points, end exclusive.  ``base`` holds the matches that pass the contract's
    checks.  ``added`` holds candidates of the other kinds that the trained classifier accepts and that touch no base
    span.  A null or empty text has none; rows with equal texts get equal results; without any candidate no model is
    trained; an empty table gives no rows; of overlapping candidates of one kind the leftmost counts; carried columns
    named like a result give way to it.
    """
    carry = carried(carry, "doc_id", "base", "added", "spans")
    found = materialise(candidates(docs, carry=carry))
    model = fit(found)
    brief = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    out = found.withColumn("base", F.transform(F.filter("spans", lambda x: x["kind"].isin(*BASE) & x["ok"]), brief))
    if model is None:
        return out.select("doc_id", *carry, "base", F.slice("base", 1, 0).alias("added"))
    free = lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    added = F.filter("spans", lambda x: ~x["kind"].isin(*BASE) & x["ok"] & (model.probability(x) >= threshold) & free(x))
    return out.select("doc_id", *carry, "base", F.transform(added, brief).alias("added"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from :func:`find_pii`."""
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[n(k) for k in BASE], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the one that starts first counts."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        between = F.substring(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        more = F.concat(acc["out"], F.array(between, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))))
        return F.when(x["start"] < acc["at"], acc).otherwise(F.struct(x["end"].alias("at"), more.alias("out")))

    whole = F.aggregate(order, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
