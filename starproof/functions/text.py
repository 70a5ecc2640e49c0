"""Display text in French notation. For reading only, never a comparison key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts and symbols shown to the reader.
DASH, NOT_AVAILABLE = "—", "n/a"
FAVOURABLE, UNFAVOURABLE, NEUTRAL = "favourable", "unfavourable", "neutral"
NO_BREAK_SPACE = "\u00a0"


def _french(x: Column, decimals: int, thousands: str = " ") -> Column:
    # format_number rounds half-even on the double, as the usual %.1f does; it signs a zero that comes from -0.0 or -0.001
    text = F.format_number(x.cast("double"), decimals)
    unsigned = F.when(x.cast("double") <= 0, F.regexp_replace(text, "^-([0.]+)$", "$1")).otherwise(text)
    return F.translate(unsigned, ",.", f"{thousands},")


def _plain(x: Column, decimals: int) -> Column:
    """No thousands separator, decimal comma."""
    return F.translate(F.format_number(x.cast("double"), decimals), ".,", ",")


def money(x: Column, decimals: int = 2) -> Column:
    """``1234567.89`` -> ``1 234 567,89 €``; missing -> dash."""
    return F.coalesce(F.concat(_french(x, decimals), F.lit(" €")), F.lit(DASH))


def raw_amount(x: Column) -> Column:
    """The export notation: no-break space for thousands, comma, two decimals."""
    return _french(x, 2, NO_BREAK_SPACE)


def integer(x: Column) -> Column:
    """``57219.8`` -> ``57 219`` (truncated); missing -> dash."""
    return F.coalesce(F.translate(F.format_number(x.cast("bigint"), 0), ",", " "), F.lit(DASH))


def _signed(x: Column, text: Column) -> Column:
    return F.concat(F.when(x >= 0, "+").otherwise(""), text)


def percent(x: Column, signed: bool = False, missing: str = DASH) -> Column:
    text = _plain(x, 1)
    return F.coalesce(F.concat(_signed(x, text) if signed else text, F.lit(" %")), F.lit(missing))


def signed_percent(x: Column) -> Column:
    return percent(x, signed=True, missing=NOT_AVAILABLE)


def signed_points(x: Column) -> Column:
    return F.coalesce(F.concat(_signed(x, _plain(x, 1)), F.lit(" pts")), F.lit(NOT_AVAILABLE))


def compact_money(x: Column) -> Column:
    """Axis labels: millions with one decimal, thousands and units without."""

    def label(value: Column, decimals: int, unit: str) -> Column:
        return F.concat(F.translate(F.format_number(value, decimals), ",", ""), F.lit(unit))

    return (
        F.when(F.abs(x) >= 1_000_000, label(x / 1_000_000, 1, "M €"))
        .when(F.abs(x) >= 1_000, label(x / 1_000, 0, "k €"))
        .otherwise(label(x, 0, " €"))
    )


def axis_percent(x: Column, signed: bool = True) -> Column:
    """Axis labels keep the decimal dot; zero is bare on a signed axis."""
    if not signed:
        return F.concat(F.translate(F.format_number(x, 0), ",", ""), F.lit(" %"))
    return F.when(x == 0, "0 %").otherwise(
        F.concat(_signed(x, F.translate(F.format_number(x, 1), ",", "")), F.lit(" %"))
    )


def favourable(x: Column, higher_is_better: bool = True) -> Column:
    good = x >= 0 if higher_is_better else x <= 0
    return F.when(x.isNull(), NEUTRAL).when(good, FAVOURABLE).otherwise(UNFAVOURABLE)


def below_average(rate: Column, average: Column) -> Column:
    return F.coalesce(rate < average, F.lit(False))


def check_value(label: Column, value: Column) -> Column:
    """Money for checks labelled in euros, a rounded count for the others."""
    return F.when(label.contains("€"), money(value)).otherwise(integer(F.bround(value, 0)))


# The customer headline and the sentences of the narrative, one per situation.
CONCENTRATION = "%s : %s %% du CA pour %d clients   |   base diversifiée : %d clients (%s %%) pour 80 %% du CA"
SENTENCES = {
    "revenue_yoy": "Le chiffre d'affaires atteint {}, {} de {} % sur un an.",
    "revenue": "Le chiffre d'affaires atteint {} sur la période.",
    "margin_move": "Le taux de marge s'établit à {} %, {} par rapport à N-1.",
    "margin": "Le taux de marge s'établit à {} %.",
    "budget": "L'activité est {} de {} % sur le CA et de {} % sur la marge.",
    "warning": (
        "Point d'attention : la croissance du CA s'accompagne d'une érosion de la marge"
        " — à investiguer (mix produit, politique de remises)."
    ),
    "up": "en hausse", "down": "en baisse",
    "gain": "en progression de {} pts", "loss": "en recul de {} pts", "flat": "stable",
    "under": "sous le budget", "over": "au-dessus du budget",
}


def concentration(segment: Column, share_pct: Column, customers: Column, core: Column, core_pct: Column) -> Column:
    """Headline of the customer sheet: leading segment, then how many customers make 80 %."""
    return F.format_string(
        CONCENTRATION, segment, _plain(share_pct, 0), customers.cast("bigint"), core.cast("bigint"), _plain(core_pct, 0)
    )


def _sentence(name: str, *values: Column) -> Column:
    return F.format_string(SENTENCES[name].replace("%", "%%").replace("{}", "%s"), *values)


def narrative() -> Column:
    """Factual reading of a summary row, from signs and thresholds only."""
    yoy, delta = F.col("revenue_yoy_pct"), F.col("margin_rate_delta_pts")
    variance = F.col("variance_revenue_pct")

    def size(x: Column) -> Column:
        return _plain(F.abs(x), 1)

    word = {k: F.lit(v) for k, v in SENTENCES.items()}
    growth = F.when(
        yoy.isNotNull(),
        _sentence("revenue_yoy", money(F.col("revenue"), 0), F.when(yoy >= 0, word["up"]).otherwise(word["down"]), size(yoy)),
    ).otherwise(_sentence("revenue", money(F.col("revenue"), 0)))
    move = F.when(delta < 0, _sentence("loss", size(delta))).when(delta > 0, _sentence("gain", size(delta))).otherwise(word["flat"])
    rate = _plain(F.col("margin_rate_pct"), 1)
    margin = F.when(delta.isNotNull(), _sentence("margin_move", rate, move)).otherwise(_sentence("margin", rate))
    budget = F.when(
        variance.isNotNull(),
        _sentence(
            "budget", F.when(variance < 0, word["under"]).otherwise(word["over"]),
            size(variance), size(F.col("variance_margin_pct")),
        ),
    )
    warning = F.when((yoy > 0) & (delta < 0), word["warning"])
    return F.concat_ws(" ", growth, margin, budget, warning)
