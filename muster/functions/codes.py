"""Column expressions for unit codes, vehicle ids, type codes and dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from muster.functions import fixed

AMBULANCE_CODE = r"-\d[AB]\d+$"
TWIN_CODE = r"-(\d)[AB](\d+)$"


def blank(value: Column) -> Column:
    """Missing text as an empty string."""
    return F.coalesce(value, F.lit(""))


def extract(value: Column, pattern: str, group: int = 0) -> Column:
    """First match, null where there is none."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def matches_any(value: Column, words: Sequence[str]) -> Column:
    """True where the text holds one of the words, in any case."""
    return blank(value).rlike("(?i)" + "|".join(words))


def date_of(value: Column) -> Column:
    """yyyy-MM-dd text to a date, null where it is none."""
    return F.try_to_date(value, "yyyy-MM-dd")


def time_of(value: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss text to a time without zone, null where it is none."""
    return F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def whole_number(value: Column) -> Column:
    """Leading whole part of numeric text, null where the text is no number."""
    return value.try_cast("double").cast("bigint")


def generic_unit(unit: Column) -> Column:
    """Unit code with the A/B crew letter dropped: CALG-1A2 to CALG-1_2."""
    return F.regexp_replace(unit, TWIN_CODE, "-$1_$2")


def grouped_unit(unit: Column) -> Column:
    """As generic_unit, only for codes that start with four capitals."""
    return F.regexp_replace(unit, r"^([A-Z]{4}-\d)[AB](\d+)$", "$1_$2")


def twin_unit(unit: Column) -> Column:
    """The B crew's code for an A crew and the reverse; null for other codes."""
    return F.when(
        unit.rlike(r"-\dA\d+$"), F.regexp_replace(unit, r"(-\d)A(\d+)$", "$1B$2")
    ).when(unit.rlike(r"-\dB\d+$"), F.regexp_replace(unit, r"(-\d)B(\d+)$", "$1A$2"))


def unit_letter(unit: Column) -> Column:
    return F.substring(unit, 7, 1)


def dispatch_group(unit: Column) -> Column:
    """First four letters, whatever they are; null where the code is shorter."""
    return extract(unit, "^(.{4})", 1)


def capital_group(unit: Column) -> Column:
    """First four letters where all are capitals."""
    return extract(unit, r"^\p{Upper}{4}")


def _from_seventh(code: Column) -> Column:
    """The rest of a type code after its six fixed characters, whatever its length."""
    return F.substring(code, F.lit(7), F.length(code))


def bare_type(key: Column) -> Column:
    """Type key without its UT_ or UT_Air_ prefix."""
    return F.regexp_replace(F.regexp_replace(key, "^UT_Air_", ""), "^UT_", "")


def lookup(value: Column, table: Mapping[str, float], otherwise: float = 0.0) -> Column:
    """Score of a value in a small fixed table."""
    pairs = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    return F.coalesce(F.try_element_at(pairs, value), F.lit(otherwise))


def type_rank_key(key: Column, class_scores: Mapping[str, float] = fixed.CLASS_SCORES) -> Column:
    """Struct that orders type keys from least to most capable.

    Class first, then stretcher, wheelchairs, capacity, air speed and the code
    itself. Missing numbers sort first, as nulls do in a Spark struct.
    """
    code = bare_type(key)
    letter = F.substring(code, 6, 1)
    suffix = _from_seventh(code).try_cast("double")
    return F.struct(
        lookup(letter, class_scores).alias("class_score"),
        lookup(F.substring(code, 1, 4), fixed.STRETCHER_SCORES).alias("stretcher"),
        F.when(F.substring(code, 1, 2).isin(fixed.WHEELCHAIR_PREFIXES), suffix)
        .otherwise(F.lit(0.0)).alias("wheelchairs"),
        F.substring(code, 5, 1).try_cast("double").alias("capacity"),
        F.when(letter.isin(fixed.AIR_LETTERS), suffix).otherwise(F.lit(0.0)).alias("air_speed"),
        code.alias("code"),
    )


def type_code_gap(key: Column) -> Column:
    """True where a wheelchair or air code lacks the number that must follow it."""
    code = bare_type(key)
    needs = F.substring(code, 1, 2).isin(fixed.WHEELCHAIR_PREFIXES) | F.substring(code, 6, 1).isin(
        fixed.AIR_LETTERS
    )
    return needs & (_from_seventh(code) == "")


def listed_rank(value: Column, ranking: Sequence[str | None] = fixed.TYPE_RANKING,
                null_ranks_lowest: bool = True) -> Column:
    """Position of a type in a fixed ranking from 1, null where it is not listed."""
    table = {name: place for place, name in enumerate(ranking, 1) if name is not None}
    pairs = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    rank = F.try_element_at(pairs, value)
    if null_ranks_lowest and None in ranking:
        return F.when(value.isNull(), F.lit(list(ranking).index(None) + 1)).otherwise(rank)
    return rank


def default_type(vehicle: Column, kind: Column) -> Column:
    """Type assumed without history: by vehicle id, else by dispatch kind."""
    number = F.coalesce(whole_number(vehicle), F.lit(-1))
    chain = None
    for name, ranges in fixed.ID_RANGE_DEFAULTS:
        test = F.lit(False)
        for low, high in ranges:
            test = test | ((number > low) & (number < high))
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    for name, kinds in fixed.KIND_DEFAULTS:
        chain = chain.when(kind.isin(kinds), name)
    return chain.otherwise(fixed.UNDEFINED_TYPE)


def unit_class(unit: Column) -> Column:
    """AMB, NAT or SUV by the unit letter; null for a letter not listed."""
    letter = unit_letter(unit)
    chain = None
    for name, letters in fixed.CLASS_LETTERS.items():
        chain = F.when(letter.isin(letters), name) if chain is None else chain.when(letter.isin(letters), name)
    return chain


def path_label(value: Column) -> Column:
    """Text as a name safe in a path: a letter first, dots for other signs."""
    dotted = F.regexp_replace(value, r"[^\p{Alnum}._]", ".")
    return F.when(dotted.rlike(r"^(\p{Alpha}|\.(?!\d))"), dotted).otherwise(F.concat(F.lit("X"), dotted))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, rounded half to even; null for an empty whole."""
    return F.bround(F.try_divide(part, whole) * 100, digits)
