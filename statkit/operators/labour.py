"""Labour-market rates of a household survey: weighted populations in one aggregation, rates over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statkit.operators.rates import ratio

#: Populations as (column, codes) that must all hold; a null code holds in none. "not 1" excludes code 1.
OCCUPIED = ("clase2", (1,))
NOT_FARM = ("ambito1", "not 1")
POPULATIONS: dict[str, tuple] = {
    "p15ymas": (),
    "pea": (("clase1", (1,)),),
    "pd": (("clase2", (2,)),),
    "po": (OCCUPIED,),
    "pona": (OCCUPIED, NOT_FARM),
    "o_menos_15hrs": (OCCUPIED, ("dur9c", (2,))),
    "pobot": (OCCUPIED, ("tpg_p8a", (1,))),
    "pasa": (OCCUPIED, ("remune2c", (1,))),
    "psub_o": (OCCUPIED, ("sub_o", (1,))),
    "pcco": (OCCUPIED, ("tcco", (1, 2, 3))),
    "posi": (OCCUPIED, ("tue2", (5,))),
    "poi": (OCCUPIED, ("emp_ppal", (1,))),
    "poina": (OCCUPIED, ("emp_ppal", (1,)), NOT_FARM),
}
#: Rate, populations of the numerator, population of the denominator.
RATES = {
    "tp": (("pea",), "p15ymas"),
    "td": (("pd",), "pea"),
    "topd": (("pd", "o_menos_15hrs"), "pea"),
    "tprg": (("pd", "pobot"), "pea"),
    "tta": (("pasa",), "po"),
    "tsub": (("psub_o",), "po"),
    "tcco": (("pcco",), "po"),
    "tosi1": (("posi",), "po"),
    "til1": (("poi",), "po"),
    "tosi2": (("posi",), "pona"),
    "til2": (("poina",), "pona"),
}
SEXES = {"h": 1, "m": 2}  #: suffix and code of column sex
SHOWN = ("p15ymas", "pea", "pd", "po", "pona")  #: populations that stay in the result


def in_universe(df: DataFrame) -> DataFrame:
    """Completed interviews of residents aged 15 to 98."""
    return df.filter((F.col("r_def") == 0) & F.col("c_res").isin(1, 3) & F.col("eda").between(15, 98))


def _holds(rules: Sequence[tuple]) -> Column:
    met = F.lit(True)
    for column, allowed in rules:
        met = met & (F.col(column) != 1 if allowed == "not 1" else F.col(column).isin(*allowed))
    return met


def labour_rates(df: DataFrame, by: Sequence[str], weight: str = "fac", sexes: Mapping[str, int] = SEXES) -> DataFrame:
    """Populations and rates in percent (2 decimals; null for an empty denominator) per group, in total and by sex."""
    groups = {"": F.lit(True)} | {f"_{suffix}": F.col("sex") == code for suffix, code in sexes.items()}
    sums = [F.sum(F.when(_holds(rules) & g, F.col(weight)).otherwise(0)).alias(f"{name}{suffix}") for suffix, g in groups.items() for name, rules in POPULATIONS.items()]
    out = df.groupBy(*by).agg(*sums)
    shown = [F.col(f"{n}{s}") for s in groups for n in SHOWN]
    top = lambda names, s: sum((F.col(f"{n}{s}") for n in names[1:]), F.col(f"{names[0]}{s}"))
    return out.select(*by, *shown, *[ratio(top(names, s), F.col(f"{below}{s}"), 100, 2).alias(f"{rate}{s}") for s in groups for rate, (names, below) in RATES.items()])
