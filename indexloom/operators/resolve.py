"""Names of entities to entities: exact name or alias, any case, code, nearest spelling; the first hit wins.

Every stage is an equi-join.  Spellings within two edits of each other share a string that both become by deleting at
most two characters, so the fuzzy stage joins on such strings and then measures the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("name", "alias", "folded", "code", "fuzzy")


def _less_one(x: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))


def deletions(x: Column, most: int = 2) -> Column:
    """``x`` and what is left of it after deleting up to ``most`` characters, each once."""
    every, last = F.array(x), F.array(x)
    for _ in range(most):
        last = F.array_distinct(F.flatten(F.transform(F.filter(last, lambda y: F.length(y) > 0), _less_one)))
        every = F.concat(every, last)
    return F.array_distinct(every)


def resolved(requests: DataFrame, entities: DataFrame, request: str, most_edits: int = 2) -> DataFrame:
    """request, entity_id and stage ('name', 'alias', 'folded', 'code', 'fuzzy' or null).

    Entities have id, name, iso_code and aliases.  Ties in a stage go to the fewest edits, then the least id.  Names of
    fewer than twice ``most_edits`` + 1 characters are not matched by spelling.  Null requests stay unresolved; repeated
    requests count once."""
    r = requests.select(F.col(request).alias("q")).distinct()
    asked = r.where("q IS NOT NULL").select("q", F.trim(F.lower("q")).alias("folded"))
    e = entities.select("id", "name", F.lower("name").alias("lower"), F.nullif("iso_code", F.lit("")).alias("iso_code"), "aliases").where("name IS NOT NULL")
    no_edits = F.lit(0).alias("edits")
    hits = [
        asked.join(e, F.col("q") == F.col("name")).select("q", "id", F.lit(1).alias("s"), no_edits),
        asked.join(e.select("id", F.explode("aliases").alias("alias")), F.col("q") == F.col("alias")).select("q", "id", F.lit(2).alias("s"), no_edits),
        asked.join(e, F.col("folded") == F.col("lower")).select("q", "id", F.lit(3).alias("s"), no_edits),
        asked.join(e, F.upper("folded") == F.col("iso_code")).select("q", "id", F.lit(4).alias("s"), no_edits),
    ]
    if most_edits:
        mine = asked.where(F.length("folded") > 2 * most_edits).select("q", "folded", F.explode(deletions(F.col("folded"), most_edits)).alias("part"))
        theirs = e.select("id", "lower", F.explode(deletions(F.col("lower"), most_edits)).alias("part"))
        near = mine.join(theirs, "part").select("q", "id", F.lit(5).alias("s"), F.levenshtein("folded", "lower").alias("edits"))
        hits.append(near.where(F.col("edits") <= most_edits).distinct())
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    best = every.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy("s", "edits", "id"))).where("n = 1")
    names = F.create_map(*[F.lit(x) for kv in enumerate(STAGES, 1) for x in kv])
    return r.join(best, "q", "left").select(F.col("q").alias(request), F.col("id").alias("entity_id"), names[F.col("s")].alias("stage"))
