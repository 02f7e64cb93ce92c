"""Seeded changes of texts: terms swapped, bullets shuffled, notes added.

Every choice is a hash of the seed, the row's id and the place of the choice,
so a row changes in the same way wherever and in whatever order it is worked on.
All are expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.operators.sampling import uniform

#: chances of a swap, of shuffled bullets, of a note before and after
SWAP, SHUFFLE, NOTE = 0.40, 0.20, 0.15
FULL = 2**32


def chance(seed: str, key: Column, place: Column | str, share: float) -> Column:
    return uniform(seed, key, F.lit(place) if isinstance(place, str) else place) < int(share * FULL)


def picked(seed: str, key: Column, place: str, options: list[str]) -> Column:
    """One of some texts."""
    return F.element_at(F.array(*map(F.lit, options)), (uniform(seed, key, F.lit(place)) % len(options)).cast("int") + 1)


def swapped(text: Column, seed: str, key: Column, terms: dict[str, list[str]]) -> Column:
    """The first occurrence of each term may become one of its alternatives, terms in order."""
    for term, others in terms.items():
        at = F.instr(text, term)
        new = F.concat(F.substring(text, F.lit(1), at - 1), picked(seed, key, f"to {term}", others), F.substring(text, at + len(term), F.length(text)))
        text = F.when((at > 0) & chance(seed, key, f"swap {term}", SWAP), new).otherwise(text)
    return text


def shuffled(text: Column, seed: str, key: Column) -> Column:
    """Paragraphs (parted by an empty line) with three bullets or more may have them in another order, behind their other lines."""

    def one(paragraph: Column, number: Column) -> Column:
        lines = F.transform(F.split(paragraph, "\n"), lambda line, i: F.struct(uniform(seed, key, F.lit("line"), number, i).alias("at"), line.alias("line")))
        bullet = lambda x: F.ltrim(x["line"]).rlike(r"^(-|[1-5]\.)")
        bullets = F.filter(lines, bullet)
        moved = F.concat(F.filter(lines, lambda x: ~bullet(x)), F.array_sort(bullets))
        again = F.array_join(F.transform(moved, lambda x: x["line"]), "\n")
        drawn = uniform(seed, key, F.lit("shuffle"), number) < int(SHUFFLE * FULL)
        return F.when((F.size(bullets) >= 3) & drawn, again).otherwise(paragraph)

    return F.array_join(F.transform(F.split(text, "\n\n"), one), "\n\n")


def noted(text: Column, seed: str, key: Column, before: list[str], after: list[str]) -> Column:
    """A note may come before the text, and one after it."""
    front = F.when(chance(seed, key, "before", NOTE), picked(seed, key, "front", before)).otherwise("")
    back = F.when(chance(seed, key, "after", NOTE), picked(seed, key, "back", after)).otherwise("")
    return F.concat(front, text, back)


def perturbed(text: Column, seed: str, key: Column, terms: dict[str, list[str]], before: list[str], after: list[str]) -> Column:
    """All three changes; a null text stays null."""
    return noted(shuffled(swapped(text, seed, key, terms), seed, key), seed, key, before, after)
