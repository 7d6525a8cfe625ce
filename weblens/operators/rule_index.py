"""An inverted index over user-agent rules (P20, J2 for large rule tables).

A pattern can only match a text that holds its literal parts. For every rule
the literal runs of its pattern are cut into grams of ``GRAMS`` characters, and the
gram that the fewest rules hold becomes the rule's key. Agents join their own grams with
the keys: what an agent has to verify with ``rlike`` are the few rules found,
however many there are. Rules without a literal run (``open``) are tested on every
distinct agent.

All of it is DataFrame code; the literal runs come from the pattern by
``regexp_replace`` steps. A step that cannot be sure takes no literal, so an
odd pattern costs time, never an answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES, materialize_sized

#: Lengths of the grams: long ones tell many similar rules apart, short ones find
#: the rest. A rule whose literal runs are all shorter is open.
GRAMS = (3, 6, 12)
BROADCAST_MAX_ROWS = 2_000_000
BROWSER_KINDS, OS_KINDS = ("browser", "robot"), ("os",)

_BREAK = "\x01"
# Escaped signs stand for themselves: each is kept as a private character while
# the pattern's own signs are taken out.
_SIGNS = "\\./-()[]{}+*?^$|"
_HELD = "".join(chr(0xE000 + i) for i in range(len(_SIGNS)))


def literal_runs(pattern: Column | str) -> Column:
    """The texts that every match of the pattern holds (array; empty if unknown)."""
    given = F.col(pattern) if isinstance(pattern, str) else pattern
    p = F.replace(given, F.lit("\\\\"), F.lit(_HELD[0]))
    for sign, held in zip(_SIGNS[1:], _HELD[1:]):
        p = F.replace(p, F.lit("\\" + sign), F.lit(held))
    p = F.regexp_replace(p, r"\\([^a-zA-Z0-9])", "$1")    # other signs mean themselves
    unsure = (p.rlike(r"\(\?[a-zA-Z-]")                 # flags change what letters mean
              | p.rlike(r"\\[^dDwWsSbBAzZtnrfvhHRGX]")  # quotes, code points, back references
              | p.rlike(r"\[[^\]]*\[")                   # nested classes
              | given.rlike("[\ue000-\ue0ff]"))
    p = F.regexp_replace(p, r"\[[^\]]*\]", _BREAK)
    for _ in range(6):  # inner groups first; deeper ones leave a bracket behind
        p = F.regexp_replace(p, r"\([^()]*\)", _BREAK)
    unsure = unsure | p.rlike(r"[()|\[\]]")              # alternatives, or not understood
    p = F.regexp_replace(p, r"\\[a-zA-Z]", _BREAK)
    p = F.regexp_replace(p, r"(?s).(?:[?*]|\{[^}]*\})[+?]?", _BREAK)
    p = F.regexp_replace(p, r"\+[+?]?|[.^$]", _BREAK)
    runs = F.transform(F.split(p, _BREAK), lambda r: F.translate(r, _HELD, _SIGNS))
    return F.when(F.coalesce(~unsure, F.lit(False)), F.filter(runs, lambda r: F.length(r) >= GRAMS[0])
                  ).otherwise(F.array().cast("array<string>"))


def grams(text: Column) -> Column:
    """The different grams of a text, of all lengths."""
    def of(n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        found = F.transform(places, lambda i: F.substring(text, i, F.lit(n)))
        return F.filter(found, lambda g: F.length(g) == n)
    return F.array_distinct(F.concat(*[of(n) for n in GRAMS]))


class RuleIndex:
    """A rule table prepared for lookups: ``keyed`` (gram, literal, rule) with one
    row a rule, and ``open``, the other rules in order as one array value."""

    def __init__(self, rules: DataFrame, broadcast_max_rows: int = BROADCAST_MAX_ROWS,
                 broadcast_max_bytes: int = BROADCAST_MAX_BYTES):
        p, k, x, n, g = rules.columns
        rule = F.struct(F.col(p).alias("priority"), F.col(k).alias("kind"), F.col(x).alias("pattern"),
                        F.col(n).alias("name"), F.col(g).alias("version_group"))
        known = rules.select(rule.alias("rule"), literal_runs(x).alias("runs")).distinct()
        longest = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(-F.length(r), r.alias("r")))), 0)["r"]
        cut = known.select("rule", longest.alias("literal"), F.explode_outer(F.array_distinct(F.flatten(
            F.transform("runs", grams)))).alias("gram"))
        # a gram's rules are counted, the rarest gram of a rule keeps it
        held = cut.where("gram IS NOT NULL").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        keyed = (cut.join(held, "gram", "left").groupBy("rule", "literal")
                 .agg(F.min(F.struct("n", (-F.length("gram")).alias("size"), "gram")).alias("key"))
                 .select(F.col("key.gram").alias("gram"), "literal", "rule"))
        table, rows, size = materialize_sized(keyed)
        self.keyed = table.where("gram IS NOT NULL")
        self.open = table.where("gram IS NULL").agg(F.sort_array(F.collect_list("rule")).alias("rules"))
        self.broadcast = rows <= broadcast_max_rows and size <= broadcast_max_bytes

    def candidates(self, agents: DataFrame) -> DataFrame:
        """(ua, literal, rule): the keyed rules whose gram an agent holds."""
        side = F.broadcast(self.keyed) if self.broadcast else self.keyed
        return agents.select("ua", F.explode(grams(F.col("ua"))).alias("gram")).join(side, "gram").drop("gram")

    def first_rules(self, agents: DataFrame) -> DataFrame:
        """Distinct agents (``ua``) with the first matching ``browser`` and ``os`` rule."""
        found = self.candidates(agents).where(
            F.contains("ua", "literal") & F.rlike("ua", F.col("rule.pattern")))

        def first(kinds: tuple[str, ...]) -> Column:
            return F.min(F.when(F.col("rule.kind").isin(*kinds), F.col("rule")))

        keyed = found.groupBy("ua").agg(first(BROWSER_KINDS).alias("_kb"), first(OS_KINDS).alias("_ko"))
        staged = agents.join(keyed, "ua", "left").withColumn("_open", self.open.scalar())

        def best(kept: str, kinds: tuple[str, ...]) -> Column:
            tested = F.get(F.filter("_open", lambda r: r["kind"].isin(*kinds) & F.rlike("ua", r["pattern"])), 0)
            return F.least(F.col(kept), tested)

        return staged.select("ua", best("_kb", BROWSER_KINDS).alias("browser"), best("_ko", OS_KINDS).alias("os"))
