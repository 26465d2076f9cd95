"""Edit scripts between two token lists, and audits of a declared change against the one that was made.

What two lists have in common is the longest chain of matching positions (Hunt and Szymanski's
view of the longest common subsequence): positions of equal tokens are points, and a chain rises on
both sides. Equal ends are cut off first, so that the points are those of the changed middle. What
lies between the chain's points are the operations; a block that is deleted at one place and
inserted at another is one move.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import udfs


def edit_script(a: Column, b: Column) -> Column:
    """The operations that make ``b`` of ``a``: kind (insertion, deletion, substitution, move) and the half-open ranges of both sides.

    All that lies between two common tokens is one operation. A move has the range that its block
    leaves (i1, i2) and the one that it comes to (j1, j2), and stands instead of a deletion and an
    insertion of the same tokens if these are all there is. Equal lists have none, null ones null.
    Time grows with the matching positions of the part that changed, times their logarithm.
    """
    return udfs.edit_operations(a, b)


def tokens_of(tokens: Column, first: Column, stop: Column) -> Column:
    return F.slice(tokens, first + 1, F.greatest(stop - first, F.lit(0)))


def changed_tokens(tokens: Column, script: Column, first: str, stop: str) -> Column:
    """All tokens of one side that a script touches, in order."""
    return F.flatten(F.transform(script, lambda o: tokens_of(tokens, o[first], o[stop])))


def mutation_errors(clean: Column, error: Column, script: Column, declared: Column) -> Column:
    """What a declared mutation gets wrong about the script from the clean to the error sentence, in a fixed order.

    ``declared`` has kind, source and target (token lists: what the clean side loses, what the error
    side gains), start and end (the marked span of the error sentence, half-open). Every changed
    token of the error side must stand in the span; where tokens were only taken away, their place
    must be in it or at one of its ends. Changed tokens must be those declared, on both sides.
    """
    one = F.get(script, F.lit(0))
    start, end = declared["start"], declared["end"]
    outside = F.exists(script, lambda o: F.when(o["j1"] == o["j2"], (o["j1"] < start) | (o["j1"] > end)).otherwise((o["j1"] < start) | (o["j2"] > end)))
    lost = F.when(one["kind"] == "move", tokens_of(clean, one["i1"], one["i2"])).otherwise(changed_tokens(clean, script, "i1", "i2"))
    rules = [
        ("no_edit", F.size(script) == 0),
        ("several_edits", F.size(script) > 1),
        ("edit_outside_span", outside),
        ("empty_span", ~(start < end)),
        ("kind_differs", (F.size(script) == 1) & ~one["kind"].eqNullSafe(declared["kind"])),
        ("source_differs", ~lost.eqNullSafe(F.coalesce(declared["source"], F.array().cast("array<string>")))),
        ("target_differs", ~changed_tokens(error, script, "j1", "j2").eqNullSafe(F.coalesce(declared["target"], F.array().cast("array<string>")))),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules]))
