"""What is read off names of samples, files and columns, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of names.
PAIR_IDS, TRAP_ID_OF_EVENTS, TRAP_ID_OF_ANALYSIS, SESSION_ID = r"(\d{3})\+(\d{3})", r"TRAP2?[-_\s]?(\d{3})", r"TRAP2?(\d+)", r"(?i)[_]?[LD](\d+)"


def animal_ids(sample: Column, of_analysis: bool = False) -> Column:
    """Array of animal ids in a sample's name: a pair, else one, else ``1``.

    The rule for events takes three digits after an optional mark; the one for
    analyses takes any digits at once after ``TRAP`` or ``TRAP2``.
    """
    single = F.regexp_extract(sample, TRAP_ID_OF_ANALYSIS if of_analysis else TRAP_ID_OF_EVENTS, 1)
    pair = F.array(F.regexp_extract(sample, PAIR_IDS, 1), F.regexp_extract(sample, PAIR_IDS, 2))
    return F.when(sample.rlike(PAIR_IDS), pair).when(single != "", F.array(single)).otherwise(F.array(F.lit("1")))


def loom_session(sample: Column) -> Column:
    """``L`` and the first number after a D or L; ``L1`` without one."""
    number = F.regexp_extract(sample, SESSION_ID, 1)
    return F.when(number != "", F.concat(F.lit("L"), number)).otherwise("L1")


def fraction(text: Column) -> Column:
    """``30000/1001`` or ``25`` as a number; null for what is neither or divides by 0."""
    top, bottom = F.split_part(text, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(text, F.lit("/"), F.lit(2))
    return F.when(F.contains(text, F.lit("/")), F.try_divide(top, bottom.try_cast("double"))).otherwise(text.try_cast("double"))
