"""Secrets in texts: fixed patterns, and Markov models of random strings against identifiers."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.llm.common import bound, match_spans
from statera.session import stored

ASSIGN_VALUE = r"[A-Za-z0-9+/_.=-]+"
#: Letters of the key words stand in either case.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?" + ASSIGN_VALUE
)
#: The greedy runs of ``AKIA[A-Z0-9]+`` with 16 characters, and of ``[0-9a-f]+`` with 32, or more.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{12,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

#: Alphabets of made random strings.
RANDOM_ALPHABETS = (
    ALPHABET[:62],
    ALPHABET[:64],
    ALPHABET[26:62],
    ALPHABET[:26] + ALPHABET[52:62],
    ALPHABET[:52],
)
#: Words of made names.
NAME_WORDS = (
    "account action address admin agent alert archive article asset audit backup base batch blog "
    "board book branch buffer build cache chapter chart client code config content count course "
    "cover data default detail device document domain draft drive email entry error event example "
    "export feature feed field file filter final folder form game group guide handler header help "
    "history home host image import index info input item job july key label large layout library "
    "light line link list local login main manager map march market media member menu message model "
    "module month mobile music name network news note number office order output page paper part "
    "path photo plan player point post price print product profile project public query read record "
    "release report request result review route sales sample schema screen script search section "
    "server service session setting share small source stage start state status store stream string "
    "style summary system table target task team template test text theme time title token track "
    "type update upload user value version video view week widget window work world year"
).split()


@dataclass(frozen=True)
class RandomStringModel:
    """Log-likelihood ratios of character pairs, first character by second, over ``ALPHABET``.

    ``threshold`` is the ratio per pair from which a token passes for random.
    """

    ratios: tuple[float, ...]
    threshold: float = math.inf

    def score(self, token: Column) -> Column:
        """The log-likelihood ratio per pair: above 0 if random is likelier than ordinary."""
        table = F.expr(f"array({','.join(f'{x:.3f}D' for x in self.ratios)})")
        k = len(ALPHABET)

        def ratio(i: Column) -> Column:
            first = F.instr(F.lit(ALPHABET), F.substring(token, i, 1))
            second = F.instr(F.lit(ALPHABET), F.substring(token, i + 1, 1))
            return F.get(table, (first - 1) * k + second - 1)

        pairs = F.length(token) - 1
        total = F.aggregate(F.sequence(F.lit(1), pairs), F.lit(0.0), lambda s, i: s + ratio(i))
        return total / pairs


def _base(text: Column) -> Column:
    """Spans of the fixed patterns as (start, end, kind), in order."""

    def of(kind: int, found: Column) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    # The value is what follows the first ":" or "=" with the blanks and quote behind it.
    value = lambda s: F.regexp_replace(s["match"], r"^[^:=]*[:=]\x20*[\"']?", "")
    assign = F.filter(match_spans(text, ASSIGN), lambda s: F.length(value(s)) >= 8)
    spans = F.concat(
        of(0, assign), of(1, match_spans(text, ACCESS)), of(2, match_spans(text, HEX))
    )
    return F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))


def made_samples(spark: SparkSession, size: int = 4000) -> DataFrame:
    """Labelled strings that are the same on every run: (sample, random), ``size`` of each label.

    Random ones are 20 to 40 characters of one of ``RANDOM_ALPHABETS``. Ordinary ones are names as
    people and programs make them: words in several spellings with numbers, dates, times, versions
    and paths, and UUIDs.
    """

    def draw(below: int | Column, *what: object) -> Column:
        """A whole number from 0 on that depends on the row and on what it is for."""
        key = [w if isinstance(w, Column) else F.lit(w) for w in what]
        return F.pmod(F.xxhash64("id", *key), F.lit(below) if isinstance(below, int) else below)

    def of_alphabet(alphabet: Column | str, size: Column, what: str) -> Column:
        alphabet = F.lit(alphabet) if isinstance(alphabet, str) else alphabet
        one = lambda i: F.substring(alphabet, draw(F.length(alphabet), what, i).cast("int") + 1, 1)
        return F.array_join(F.transform(F.sequence(F.lit(1), size), one), "")

    words = F.array(*[F.lit(word) for word in NAME_WORDS])
    word = lambda what: F.get(words, draw(len(NAME_WORDS), "word", what).cast("int"))
    number = lambda digits, what: F.lpad(draw(10**digits, "number", what).cast("string"), digits, "0")
    year = (F.lit(1990) + draw(40, "year")).cast("string")
    two = lambda most, what: F.lpad((draw(most, what) + 1).cast("string"), 2, "0")
    date = lambda sep: F.concat_ws(sep, year, two(12, "month"), two(28, "day"))
    mark = F.get(F.array(F.lit("_"), F.lit("-")), draw(2, "mark").cast("int"))
    some = lambda most: F.transform(
        F.sequence(F.lit(1), (draw(most, "words") + 2).cast("int")), lambda i: word(i)
    )
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))

    def marked(*parts: Column) -> Column:
        """The parts with one mark between them, the same in a row."""
        return F.concat(parts[0], *[x for part in parts[1:] for x in (mark, part)])

    hex_digits = "0123456789abcdef"
    uuid = F.concat_ws(
        "-", *[of_alphabet(hex_digits, F.lit(n), f"uuid{k}") for k, n in enumerate((8, 4, 4, 4, 12))]
    )
    names = (
        marked(F.array_join(some(4), "_"), F.lit("v"), number(1, 0), word("a"), year),
        marked(word("a"), F.regexp_replace(date("-"), "-", ""), word("b"), word("c")),
        F.concat_ws("_", word("a"), date("_"), F.array_join(some(2), "_")),
        F.concat_ws("-", word("a"), number(2, 1), word("b"), number(1, 2), word("c"), number(1, 3)),
        F.concat(date("-"), F.lit("T"), two(23, "hour"), F.lit("-"), two(59, "minute"), F.lit("-00-"), word("a")),
        F.concat(F.lit("https-www-"), F.array_join(some(2), "-"), F.lit("-com-"), word("a"), F.lit("-"), number(5, 4)),
        F.concat(F.lit("com/"), F.array_join(some(3), "/"), F.lit("/src/main/"), capital(word("a")), number(1, 5)),
        F.concat(F.array_join(F.transform(some(3), capital), ""), number(2, 6), capital(word("a")), capital(word("b"))),
        F.concat_ws("_", F.upper(word("a")), F.upper(word("b")), F.upper(word("c")), number(3, 7)),
        marked(F.array_join(some(4), "_"), number(4, 8)),
        F.array_join(some(5), "-"),
        uuid,
    )
    alphabet = F.get(F.array(*[F.lit(a) for a in RANDOM_ALPHABETS]), draw(len(RANDOM_ALPHABETS), "alphabet").cast("int"))
    random = of_alphabet(alphabet, (draw(21, "length") + 20).cast("int"), "random")
    ordinary = F.get(F.array(*names), draw(len(names), "kind").cast("int"))
    return spark.range(size).select(
        F.explode(
            F.array(
                F.struct(random.alias("sample"), F.lit(True).alias("random")),
                F.struct(ordinary.alias("sample"), F.lit(False).alias("random")),
            )
        ).alias("s")
    ).select("s.sample", "s.random")


def labelled_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Labelled strings of a corpus: (sample, random).

    Values that the fixed patterns find are random; tokens of twelve or more characters outside
    them, with digits or without, are ordinary.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = rf"(?:{ASSIGN})|{ACCESS}|{HEX}"
    secrets = F.transform(
        F.when(text.rlike(found), F.regexp_extract_all(text, F.lit(f"({found})"), F.lit(1))),
        lambda s: F.regexp_replace(s, r"^[^:=]*[:=]\x20*[\"']?", ""),
    )
    left = F.when(text.rlike(found), F.regexp_replace(text, found, " ")).otherwise(text)
    samples = F.concat(
        F.transform(
            F.filter(F.coalesce(secrets, F.array().cast("array<string>")), lambda s: F.length(s) >= 16),
            lambda s: F.struct(s.alias("sample"), F.lit(True).alias("random")),
        ),
        F.transform(
            F.regexp_extract_all(left, F.lit(IDENTIFIER), F.lit(0)),
            lambda s: F.struct(s.alias("sample"), F.lit(False).alias("random")),
        ),
    )
    return docs.select(F.explode(samples).alias("s")).select("s.sample", "s.random")


def train(
    samples: DataFrame, smoothing: float = 1.0, false_rate: float = 0.005, missed_rate: float = 0.02
) -> RandomStringModel:
    """Fit both models and the threshold: all counting is in Spark, pre-aggregated in every task.

    ``samples`` has ``sample`` (string) and ``random`` (boolean). One sample in five by hash is held
    out. Of the others character pairs are counted; what comes to the driver is one row per label
    and pair of alphabet characters, 67 * 67 * 2 at most. The threshold lies half way between the
    ratio that ``false_rate`` of the held-out ordinary samples reach and the one that
    ``missed_rate`` of the random ones do not, and never below the former.

    Null samples and pairs outside the alphabet do not count. Without held-out samples of both
    labels nothing passes for random; without any sample every ratio is 0.
    """
    held = F.pmod(F.xxhash64("sample"), F.lit(5)) == 0
    usable = samples.filter(F.length("sample") > 1)
    pairs = usable.filter(~held).select(
        "random",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("sample") - 1),
                lambda i: F.substring(F.col("sample"), i, 2),
            )
        ).alias("pair"),
    )
    counted = pairs.groupBy("random", "pair").count()
    counts: dict[tuple[bool, str], int] = {
        (r["random"], r["pair"]): r["count"]
        for r in counted.filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$")).collect()
    }
    k = len(ALPHABET)

    def log_chances(label: bool) -> list[float]:
        """Of each second character after each first, drawn towards the characters' own shares."""
        seen = [[counts.get((label, a + b), 0) for b in ALPHABET] for a in ALPHABET]
        shares = [sum(row[i] for row in seen) + smoothing for i in range(k)]
        whole = sum(shares)
        return [
            math.log((row[i] + smoothing * k * shares[i] / whole) / (sum(row) + smoothing * k))
            for row in seen
            for i in range(k)
        ]

    ratios = [a - b for a, b in zip(log_chances(True), log_chances(False), strict=True)]
    model = RandomStringModel(tuple(ratios))
    scored = usable.filter(held & F.col("sample").rlike(r"^[A-Za-z0-9+/_=-]{12,}$")).select(
        "random", model.score(F.col("sample")).alias("score")
    )
    of = lambda label, rate: F.percentile_approx(F.when(F.col("random") == label, F.col("score")), rate, 10_000)
    ordinary, random = scored.agg(of(False, 1 - false_rate), of(True, missed_rate)).first()
    if ordinary is None or random is None:
        return model
    return RandomStringModel(model.ratios, max(ordinary, (ordinary + random) / 2))


def scan_secrets(
    docs: DataFrame,
    model: RandomStringModel,
    text_col: str = "text",
    least_score: float | None = None,
    mark: str = "[SECRET]",
) -> DataFrame:
    """Add ``secrets`` (array of start, end, kind, in code points) and ``redacted`` (the text).

    The fixed patterns' spans all stay. The models add tokens of twenty or more characters that
    hold a letter, have a ratio per pair above the model's threshold (or ``least_score``) and touch
    no fixed span. In ``redacted`` every run of overlapping spans gives one ``mark``.

    Null texts have no secrets and stay null. Repeated rows are scanned alike, an empty table
    gives an empty result. Input columns of the added names are replaced. No shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    least = model.threshold if least_score is None else least_score

    def with_random(base: Column) -> Column:
        found = F.filter(
            match_spans(text, CANDIDATE),
            lambda c: c["match"].rlike("[A-Za-z]")
            & ~F.exists(base, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
            & (model.score(c["match"]) > F.lit(float(least))),
        )
        added = F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")
            ),
        )
        return F.sort_array(F.concat(base, added))

    names = F.array(*[F.lit(kind) for kind in KINDS])
    spans = F.transform(
        bound(_base(text), with_random),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), names[s["kind"]].alias("kind")
        ),
    )

    def cut(seen: Column, s: Column) -> Column:
        gap = F.substring(text, (seen["at"] + 1).cast("int"), (s["start"] - seen["at"]).cast("int"))
        return F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(s["start"] >= seen["at"], F.concat(seen["out"], gap, F.lit(mark)))
            .otherwise(seen["out"])
            .alias("out"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = lambda seen: F.concat(seen["out"], F.substr(text, (seen["at"] + 1).cast("int")))
    redacted = F.when(
        F.size("secrets") > 0, F.aggregate("secrets", start, cut, rest)
    ).otherwise(F.col(text_col))
    kept = [c for c in docs.columns if c not in ("secrets", "redacted")]
    found = docs.select(*kept, spans.alias("secrets"))
    return found.select(*found.columns, redacted.alias("redacted"))


def corpus_model(docs: DataFrame, text_col: str = "text") -> RandomStringModel:
    """The models of a corpus: its own labelled strings, and the made ones beside them.

    A corpus may hold hardly a random string, and hardly a name with digits in it; the made samples
    see to it that both models know digits. The samples, which are read twice, are written to the
    shared folder.
    """
    own = labelled_samples(docs, text_col).unionByName(made_samples(docs.sparkSession))
    return train(stored(own, "samples"))


def joined(spans: Column | str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
