"""Secret scans with DataFrame functions only.

Base spans come from three patterns. The method adds spans of kind ``random``: runs of 20 or more
characters of a base-64 alphabet that look drawn at random. The encoding of a run is inferred
from its characters (hex, base 32, 36, 62 or 64); a run of letters of one case or of digits alone
has none and is left out. Two tests ask whether ordinary text could look as random as the run:

* alphabet uniformity: the chi-squared statistic, under ordinary text noncentral with the
  excess of repeated symbols that words (or, for hex, decimal digits) have;
* runs: the number of changes between digits, lower and upper case, under ordinary text binomial
  with half the changes of a random run.

Where each rejects at 0.025 their p-values are combined by Fisher's method, else the largest counts.
Serial correlation of neighbouring symbols says nothing against ordinary text, which has little of
it either: it only vetoes. A run whose correlation fewer than one in a hundred random runs exceed
(Fisher's z) is ordered, and has p-value 1. Runs are declared by Benjamini-Hochberg at rate ``rate``
within each length band, as short runs carry less evidence and must not borrow from long ones. For
this the p-values of all documents are counted in bins of a tenth of a decade, at the bin's upper
edge: a table of bounded size, whatever the input.

Positions are code points, the end is exclusive. Java's patterns match leftmost without overlap;
a position is the length of what ``split`` and the matches before it took.

Defined results: a null text is empty and has no span; repeated rows are scanned each and their
runs counted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import packed, table, unpacked, whole_text, written

#: The patterns of the base kinds, in the order of their names in a result.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
RUN = r"[A-Za-z0-9+/_-]{20,}"
RATE = 0.05
#: Upper ends of the length bands.
BANDS = (24, 32, 48, 64, 128)
BINS = 300
#: Matches that are placed together.
_SLICE_BITS = 6
_SLICE = 1 << _SLICE_BITS

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encoding, the characters it is inferred from, and its symbols in order.
ENCODINGS = (
    ("hex", r"[0-9a-f]+|[0-9A-F]+", _DIGITS + "abcdef"),
    ("base32", r"[A-Z2-7]+", _UPPER + "234567"),
    ("base36", r"[0-9a-z]+|[0-9A-Z]+", _DIGITS + _LOWER),
    ("base62", r"[0-9A-Za-z]+", _DIGITS + _UPPER + _LOWER),
    ("base64", r".+", _UPPER + _LOWER + _DIGITS + "+/"),
)
#: Chance that two symbols of ordinary text agree: English letters; decimal digits for hex.
_REPEAT, _REPEAT_HEX = 0.0667, 0.1
#: Fisher's z of the neighbours' correlation that one in a hundred random runs exceeds.
_ORDERED = 2.576
#: Level at which each of the two tests has to reject by itself: half of 0.05.
_EACH = 0.025


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` applied to a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _before(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each whole number what those before it are joined to, 0 for the first one.

    In two levels: slices are joined first, then the values of each slice, so that no step copies
    all results so far.
    """
    zero = F.lit(0)

    def of_slices(all_values: Column) -> Column:
        done = F.aggregate(
            F.sequence(zero, F.shiftright(F.size(all_values), _SLICE_BITS)),
            F.struct(zero.alias("at"), F.array().cast("array<int>").alias("list")),
            lambda d, j: F.struct(
                join(d["at"], F.aggregate(
                    F.slice(all_values, F.shiftleft(j, _SLICE_BITS) + 1, _SLICE), zero, join
                )).alias("at"),
                F.concat(d["list"], F.array(d["at"])).alias("list"),
            ),
            lambda d: d["list"],
        )
        return _let(done, lambda slices: F.transform(all_values, lambda _, i: F.aggregate(
            F.slice(
                all_values, i - i.bitwiseAND(F.lit(_SLICE - 1)) + 1, i.bitwiseAND(F.lit(_SLICE - 1))
            ),
            F.get(slices, F.shiftright(i, _SLICE_BITS)), join,
        )))

    return _let(values, of_slices)


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, end, matched text of ``group``) of every match, leftmost without overlap."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    taken = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.arrays_zip(
        gaps.alias("gap"), F.transform(whole, F.length).alias("size"), taken.alias("taken")
    )

    def placed(matches: Column) -> Column:
        ends_before = _before(
            F.transform(matches, lambda s: s["gap"] + s["size"]), lambda a, b: a + b
        )
        return F.zip_with(matches, ends_before, lambda s, at: F.struct(
            (at + s["gap"]).alias("start"), (at + s["gap"] + s["size"]).alias("end"),
            s["taken"].alias("taken"),
        ))

    empty = F.array().cast("array<struct<start: int, end: int, taken: string>>")
    # One gap more than matches: the last one ends the text.
    found = _let(F.filter(steps, lambda s: s["size"].isNotNull()), placed)
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _normal(z: Column) -> Column:
    """Standard normal distribution function (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    tail = 0.5 * F.exp(-x * x) * t * (
        0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))
    )
    return F.when(z < 0, tail).otherwise(1 - tail)


def _choice(name: Column, values: dict[str, object]) -> Column:
    result = F.lit(None)
    for key, value in values.items():
        result = F.when(name == key, F.lit(value)).otherwise(result)
    return result


def _uniformity(run: Column, size: Column, symbols: Column, repeat: Column) -> Column:
    """P(as even a use of the alphabet | ordinary text)."""
    kinds = F.length(symbols).cast("double")
    squares = F.aggregate(
        F.split(symbols, ""), F.lit(0.0),
        lambda total, s: total + F.pow(size - F.length(F.replace(run, s, F.lit(""))), F.lit(2.0)),
    )
    statistic = squares * kinds / size - size
    excess = size * (kinds * repeat - 1)
    return _normal(
        (statistic - (kinds - 1 + excess)) / F.sqrt(2 * (kinds - 1) + 4 * excess)
    )


def _runs(run: Column, size: Column, changes: Column) -> Column:
    """P(as many changes between character classes | ordinary text)."""
    classes = F.translate(run, _DIGITS + _LOWER + _UPPER + "+/", "d" * 10 + "l" * 26 + "u" * 26 + "oo")
    seen = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
    share = changes / 2
    return _normal(
        ((size - 1) * share - seen) / F.sqrt((size - 1) * share * (1 - share))
    )


def _ordered(run: Column, size: Column, symbols: Column) -> Column:
    """Whether neighbours are correlated as those of a random run are not."""
    values = F.transform(
        F.slice(F.split(run, ""), 1, size.cast("int")), lambda c: F.instr(symbols, c).cast("double")
    )
    zero = F.lit(0.0)
    total = lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)
    correlation = _let(values, lambda v: _let(total(v) / size, lambda mean: _let(
        F.transform(v, lambda x: x - mean), lambda d: F.abs(
            total(F.zip_with(
                F.slice(d, 1, (size - 1).cast("int")), F.slice(d, 2, (size - 1).cast("int")),
                lambda a, b: a * b,
            )) / F.greatest(total(F.transform(d, lambda x: x * x)), F.lit(1e-9))
        ),
    )))
    bounded = F.least(correlation, F.lit(0.999999))
    return F.atanh(bounded) * F.sqrt(size - 3) > _ORDERED


def _together(first: Column, second: Column) -> Column:
    """Fisher's method for two p-values; the largest counts where one test does not reject."""

    def one(p: Column) -> Column:
        largest = F.greatest(p["first"], p["second"])
        fisher = _let(
            F.greatest(p["first"] * p["second"], F.lit(1e-40)), lambda x: x * (1 - F.log(x))
        )
        return F.when(largest > _EACH, F.greatest(largest, fisher)).otherwise(fisher)

    return _let(F.struct(first.alias("first"), second.alias("second")), one)


def _evidence(run: Column) -> Column:
    """(band, bin) of a run, or null if no encoding is inferred; a higher bin is less ordinary."""
    shape = F.translate(run, "-_", "+/")
    name = F.lit(None).cast("string")
    for encoding, pattern, _ in reversed(ENCODINGS):
        name = F.when(shape.rlike(f"^(?:{pattern})$"), encoding).otherwise(name)
    mixed = shape.rlike("[0-9]") & shape.rlike("[A-Za-z]") | (
        shape.rlike("[a-z]") & shape.rlike("[A-Z]")
    )

    def judged(encoding: Column) -> Column:
        symbols = _choice(encoding, {n: s for n, _, s in ENCODINGS})
        changes = _choice(encoding, {n: _changes(s) for n, _, s in ENCODINGS})
        repeat = _choice(encoding, {n: _REPEAT_HEX if n == "hex" else _REPEAT for n, _, _ in ENCODINGS})
        # Upper-case hex and base 36 have the symbols of the lower-case form.
        text = F.when(encoding.isin("hex", "base36"), F.lower(shape)).otherwise(shape)
        size = F.length(shape).cast("double")
        p = F.when(_ordered(text, size, symbols), 1.0).otherwise(_together(
            _uniformity(text, size, symbols, repeat), _runs(shape, size, changes)
        ))
        band = F.lit(len(BANDS))
        for i, end in reversed(list(enumerate(BANDS))):
            band = F.when(size < end, i).otherwise(band)
        level = F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-30)))).cast("int")
        return F.struct(band.alias("band"), F.least(level, F.lit(BINS)).alias("bin"))

    return F.when(mixed, _let(name, judged))


def _changes(symbols: str) -> float:
    """Chance that neighbours of a random run are of different character classes."""
    classes = [sum(map(test, symbols)) for test in (str.isdigit, str.islower, str.isupper)]
    classes.append(len(symbols) - sum(classes))
    return 1 - sum((n / len(symbols)) ** 2 for n in classes)


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds as (start, kind's place, end), by start and kind."""
    found = [
        F.filter(_spans(text, ASSIGN, 2), lambda s: F.length(s["taken"]) >= 12),
        _spans(text, ACCESS),
        _spans(text, HEX),
    ]
    return F.array_sort(F.concat(*(
        F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("kind"), s["end"].alias("end"),
        )) for place, spans in enumerate(found)
    )))


def random_runs(text: Column) -> Column:
    """Runs with an inferred encoding as (start, kind's place, end, band, bin)."""
    judged = F.transform(_spans(text, RUN), lambda s: _let(_evidence(s["taken"]), lambda e: F.struct(
        s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end"),
        e["band"].alias("band"), e["bin"].alias("bin"),
    )))
    return F.filter(judged, lambda s: s["bin"].isNotNull())


def least_bins(runs: DataFrame, rate: float = RATE) -> Column:
    """Benjamini-Hochberg within each length band: the least bin that is declared, by band.

    ``runs`` has one column ``runs`` of all documents' runs.
    """
    counted = runs.select(F.inline("runs")).groupBy("band", "bin").count()
    band = Window.partitionBy("band")
    declared = (
        counted.withColumn("rank", F.sum("count").over(band.orderBy(F.desc("bin"))))
        .withColumn("all", F.sum("count").over(band))
        .where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= F.lit(rate) * F.col("rank") / F.col("all"))
        .groupBy("band").agg(F.min("bin").alias("least"))
    )
    least = {r["band"]: r["least"] for r in declared.collect()}
    return F.array(*(F.lit(least.get(b, BINS + 1)) for b in range(len(BANDS) + 1)))


def declared_runs(runs: Column, least: Column) -> Column:
    kept = F.filter(runs, lambda s: s["bin"] >= F.get(least, s["band"]))
    return F.transform(kept, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")
    ))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def secret_spans(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, base, spans) of every row; spans are sorted by start, kind and end."""
    text = whole_text()
    found = written(
        docs.select("doc_id", base_spans(text).alias("base"), random_runs(text).alias("runs")),
        "secrets",
    )
    runs = declared_runs(F.col("runs"), least_bins(found, rate))
    return found.select(
        "doc_id", "base", F.array_sort(F.concat("base", runs)).alias("spans")
    )


def masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with every stretch that spans cover replaced by ``mask``; spans are sorted.

    The text is cut slice by slice of the spans, so that a cut is not counted off from the
    beginning of the whole text.
    """

    def cut(part: Column) -> Column:
        base = F.get(part, F.lit(0))["at"]
        reach = F.array_max(F.transform(part, lambda s: s["start"])) - base

        def pieces(stretch: Column) -> Column:
            return F.array_join(F.transform(part, lambda s: F.when(
                s["start"] >= s["at"], F.concat(
                    F.substring(stretch, s["at"] - base + 1, s["start"] - s["at"]), F.lit(mask)
                ),
            ).otherwise(F.lit(""))), "")

        return _let(F.substring(text, base + 1, F.greatest(reach, F.lit(0))), pieces)

    def whole(held: Column) -> Column:
        slices = F.transform(
            F.sequence(F.lit(0), F.shiftright(F.size(held) - 1, _SLICE_BITS)),
            lambda j: _let(F.slice(held, F.shiftleft(j, _SLICE_BITS) + 1, _SLICE), cut),
        )
        end = F.array_max(F.transform(held, lambda s: s["end"]))
        return F.concat(F.array_join(slices, ""), F.substring(text, end + 1, F.length(text)))

    # ``at``: where the spans before this one end.
    ends = _before(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    with_ends = F.zip_with(spans, ends, lambda s, at: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), at.alias("at")
    ))
    return F.when(F.size(spans) > 0, _let(with_ends, whole)).otherwise(text)


def redacted(docs: DataFrame, rate: float = RATE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with all secrets masked and, where the text changed, ``n_chars`` counted anew.

    Texts are scanned once; the rows are written with what was found, until all runs are counted.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = written(
        packed(docs).select("row", base_spans(text).alias("base"), random_runs(text).alias("runs")),
        "scanned",
    )
    least = least_bins(rows.select("runs"), rate)
    found = rows.select(
        "row",
        F.array_sort(F.concat("base", declared_runs(F.col("runs"), least))).alias("spans"),
    )
    changed = F.when(F.size("spans") > 0, masked(text, F.col("spans"), mask)).otherwise(
        F.col("row.text")
    )
    fields = {"text": changed}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.when(
            F.size("spans") > 0, F.length(changed).cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("row.n_chars"))
    return unpacked(found, docs.columns, **fields)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda place: F.size(F.filter("base", lambda s: s["kind"] == place)).cast("long")
    return found.select(
        "doc_id",
        *(count(place).alias(f"n_{kind}") for place, kind in enumerate(KINDS[:3])),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
