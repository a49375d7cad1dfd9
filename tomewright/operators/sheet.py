"""Character-sheet arithmetic: typed bonuses that stack or not, range tables, attack series, slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewright.functions.text import normal, spaces


def stack_bonuses(rows: DataFrame, rules: DataFrame, owner: str, kind: str, value: str, position: list[str]) -> DataFrame:
    """rows with ``counts`` and ``flagged``. Types that accumulate sum up; others keep the best bonus (>= 0) and the
    worst malus (< 0), the first in position among equals; types without a rule sum up but are flagged.

    rules: (kind, cumulative boolean); a small dimension. It is sent to all tasks, as a join by kind would put all rows of a kind
    into one."""
    ruled = rows.join(F.broadcast(rules), kind, "left")
    sign = F.when(F.col(value) < 0, 1).otherwise(0)
    window = Window.partitionBy(owner, kind, sign).orderBy(F.abs(F.col(value)).desc(), *position)
    counts = F.when(F.col("cumulative") == F.lit(False), F.row_number().over(window) == 1).otherwise(True)
    return ruled.withColumns({"counts": counts, "flagged": F.col("cumulative").isNull()})


def stacked_totals(rows: DataFrame, rules: DataFrame, owner: str, kind: str, value: str, position: list[str]) -> DataFrame:
    """owner, total, n_counted, n_lost, n_flagged, as of ``stack_bonuses``. Of a type that doesn't accumulate one value of each
    sign counts whichever is the first, so sums are enough: no order, and no group is held by a task."""
    v = F.col(value)
    dealt = rows.select(owner, kind, v.alias("__v"), F.coalesce(v < 0, F.lit(False)).alias("__malus")).repartition(owner)
    summed = dealt.groupBy(owner, kind, "__malus").agg(F.sum("__v").alias("__sum"), F.count("*").alias("__n"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
    lone = F.coalesce(~F.col("cumulative"), F.lit(False))
    total = F.when(lone, F.when(F.col("__malus"), F.col("__least")).otherwise(F.col("__most"))).otherwise(F.col("__sum"))
    told = summed.join(F.broadcast(rules), kind, "left").select(owner, total.alias("total"), "__n", F.when(lone, F.lit(1)).otherwise(F.col("__n")).alias("counted"), F.when(F.col("cumulative").isNull(), F.col("__n")).otherwise(0).alias("flagged"))
    return told.groupBy(owner).agg(F.sum("total").alias("total"), F.sum("counted").alias("n_counted"), F.sum(F.col("__n") - F.col("counted")).alias("n_lost"), F.sum("flagged").alias("n_flagged"))


#: Ranges that become one CASE; more are met by a join.
RANGES = 256


def range_lookup(rows: DataFrame, ranges: DataFrame, value: str) -> DataFrame:
    """rows with ``modifier`` of the range (low, high, modifier; both ends inside) that holds the value; null outside.

    Ranges don't overlap. A rule table of a few rows becomes one CASE, without a join or shuffle. A larger one is met by the
    range that starts last at or below the value: both are put in one order of (value), and the last start is carried on."""
    few = ranges.orderBy("low").limit(RANGES + 1).collect()
    if len(few) <= RANGES:
        out = None
        for r in few:
            inside = F.col(value).between(r["low"], r["high"])
            out = F.when(inside, r["modifier"]) if out is None else out.when(inside, r["modifier"])
        return rows.withColumn("modifier", F.lit(None).cast("int") if out is None else out)
    wanted = rows.select(F.col(value).alias("v")).where("v IS NOT NULL").distinct().select("v", F.lit(None).cast("struct<low:bigint,high:bigint,modifier:int>").alias("r"))
    starts = ranges.select(F.col("low").alias("v"), F.struct(F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"), F.col("modifier").cast("int").alias("modifier")).alias("r"))
    both = wanted.unionByName(starts)
    block = F.floor(F.col("v") / F.lit(1 << 16))  # blocks of values; the last range of the blocks before is carried in
    inside = Window.partitionBy("block").orderBy("v", F.col("r").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("block", block).withColumn("at", F.last("r", True).over(inside))
    lasts = both.groupBy("block").agg(F.max_by("r", F.struct(F.col("r").isNotNull(), "v")).alias("r"))
    carried = lasts.withColumn("before", F.last("r", True).over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).select("block", "before")
    met = both.where("r IS NULL").join(carried, "block").select("v", F.coalesce("at", "before").alias("m"))
    met = met.select("v", F.when(F.col("v") <= F.col("m.high"), F.col("m.modifier")).alias("modifier"))
    met = met.withColumnRenamed("v", "__v")
    return rows.join(met, F.col(value) == F.col("__v"), "left").drop("__v")


def attack_series(bonus: Column) -> Column:
    """bonus, bonus - 5, ... with 1 + floor((bonus - 1) / 5) terms."""
    return F.when(bonus >= 1, F.transform(F.sequence(F.lit(0), F.floor((bonus - 1) / 5).cast("int")), lambda i: bonus - 5 * i)).otherwise(F.array(bonus))


def armour_class(base: Column, dexterity: Column, cap: Column, armour: Column, size: Column) -> Column:
    """Total, touch and flat-footed; a missing input voids what needs it."""
    dex = F.when(cap.isNull(), dexterity).otherwise(F.least(dexterity, cap))
    dex = F.when(dexterity.isNull(), F.lit(None)).otherwise(dex)
    return F.struct((base + dex + armour + size).alias("total"), (base + dex + size).alias("touch"), (base + armour + size + F.least(dex, F.lit(0))).alias("flat_footed"))


def feat_slots(rows: DataFrame, owner: str, level: str, race_bonus: Column, bonus_levels: Column) -> DataFrame:
    """owner, source, level: general slots at level 1 and each odd level, one racial, and the class's own."""
    general = F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.col(level), F.lit(1))), lambda x: (x % 2 == 1) & (x <= F.col(level))), lambda x: F.struct(F.lit("general").alias("source"), x.alias("level")))
    racial = F.when(race_bonus, F.array(F.struct(F.lit("racial").alias("source"), F.lit(1).alias("level"))))
    own = F.transform(F.filter(bonus_levels, lambda x: x <= F.col(level)), lambda x: F.struct(F.lit("class").alias("source"), x.alias("level")))
    return rows.select(owner, F.explode(F.flatten(F.array_compact(F.array(general, racial, own)))).alias("s")).select(owner, "s.source", "s.level")


def caster_level(entered: Column, caster_levels: Column) -> Column:
    """What was entered, else the level of the only caster class, else null."""
    return F.coalesce(entered, F.when(F.size(caster_levels) == 1, F.element_at(caster_levels, 1)))


def slot_totals(rows: DataFrame, owner: str) -> DataFrame:
    """owner, level, total of (owner, level, base, bonus): a missing base voids all levels of the owner."""
    summed = rows.groupBy(owner, "level").agg(F.sum("base").alias("base"), F.sum("bonus").alias("bonus"), F.bool_or(F.col("base").isNull()).alias("void"))
    void = F.bool_or("void").over(Window.partitionBy(owner))
    return summed.withColumn("gone", void).select(owner, "level", F.when(~F.col("gone"), F.col("base") + F.coalesce("bonus", F.lit(0))).alias("total"))


# Size modifiers of armour class and attacks; manoeuvres take them with the other sign. Sizes whose
# manoeuvres go by dexterity.
SIZE_MODIFIERS = {"colossal": -8, "colossale": -8, "gigantesque": -4, "tres grand": -2, "tres grande": -2, "tg": -2, "grand": -1, "grande": -1, "g": -1, "moyen": 0, "moyenne": 0, "m": 0, "petit": 1, "petite": 1, "p": 1, "tres petit": 2, "tres petite": 2, "tp": 2, "minuscule": 4, "min": 4, "infime": 8, "i": 8}
BY_DEXTERITY = ["tres petit", "tres petite", "tp", "minuscule", "min", "infime", "i"]
ARMOUR_BASE, CLASS_SKILL_BONUS, SPELL_BASE, DEFENCE_BASE = 10, 3, 10, 10
TOUCH_LACKS = ["armure", "bouclier", "armure_naturelle"]
SURPRISED_LACKS = ["dexterite", "esquive"]


def size_key(size: Column) -> Column:
    return spaces(normal(size))


def size_modifier(size: Column) -> Column:
    """Null for an unknown size."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in SIZE_MODIFIERS.items() for x in kv]), size_key(size))


def effective(base: Column, bonuses: Column) -> Column:
    """An ability with its stacked bonuses; null without a base."""
    return base + F.coalesce(bonuses, F.lit(0))


def saving_throw(base: Column, modifier: Column, bonuses: Column) -> Column:
    """Never the modifier alone: null where the base or the modifier is."""
    return base + modifier + F.coalesce(bonuses, F.lit(0))


def contribution(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.cast("int").alias("value"))


def armour_contributions(armour: Column, shield: Column, dexterity: Column, cap: Column, size: Column) -> Column:
    """Array of (kind, value). No armour or shield is 0; a null value of one that is worn, an unknown size or a null
    dexterity stay null. armour, shield: struct (worn, bonus)."""
    dex = F.when(cap.isNotNull() & (dexterity > cap), cap).otherwise(dexterity)
    worn = lambda c: F.when(c["worn"], c["bonus"]).otherwise(0)
    return F.array(contribution("base", F.lit(ARMOUR_BASE)), contribution("armure", worn(armour)), contribution("bouclier", worn(shield)), contribution("dexterite", dex), contribution("taille", size_modifier(size)))


def armour_variants(contributions: Column, bonuses: Column) -> Column:
    """struct (total, touch, surprised) of the contributions and resolved bonuses, both arrays of (kind, value); a null
    contribution voids all three."""
    whole = F.concat(contributions, F.coalesce(bonuses, F.array().cast("array<struct<kind:string,value:int>>")))
    void = F.exists(contributions, lambda c: c["value"].isNull())
    total = lambda lacks: F.when(~void, F.aggregate(F.filter(whole, lambda c: ~c["kind"].isin(*lacks)) if lacks else whole, F.lit(0), lambda acc, c: acc + c["value"]))
    return F.struct(total([]).alias("total"), total(TOUCH_LACKS).alias("touch"), total(SURPRISED_LACKS).alias("surprised"))


def speed(base: Column, category: Column, table: dict[str, dict[str, str]]) -> Column:
    """The base without armour; else what the table (category to base text to text) says, null where it says nothing."""
    pairs = F.create_map(*[F.lit(x) for c, row in table.items() for b, text in row.items() for x in (f"{c}|{b}", text)])
    whole = F.when(base == F.floor(base), base.cast("long").cast("string")).otherwise(F.replace(base.cast("string"), F.lit("."), F.lit(",")))
    listed = F.regexp_extract(F.trim(F.try_element_at(pairs, F.concat(category, F.lit("|"), whole, F.lit(" m")))), r"^(\d+(?:,\d+)?)", 1)
    return F.when(F.coalesce(category, F.lit("")) == "", base.cast("double")).otherwise(F.replace(listed, F.lit(","), F.lit(".")).try_cast("double"))


def manoeuvre_bonus(attack: Column, strength: Column, dexterity: Column, size: Column) -> Column:
    return attack + F.when(size_key(size).isin(*BY_DEXTERITY), dexterity).otherwise(strength) - size_modifier(size)


def manoeuvre_defence(attack: Column, strength: Column, dexterity: Column, size: Column) -> Column:
    return DEFENCE_BASE + attack + strength + dexterity - size_modifier(size)


def attack_total(attack: Column, ability: Column, modifier: Column, size: Column, bonuses: Column) -> Column:
    """An attack that goes by no ability adds 0 for it."""
    return attack + F.when(ability.isNull(), 0).otherwise(modifier) + size_modifier(size) + F.coalesce(bonuses, F.lit(0))


def attack_totals(attack: Column, ability: Column, modifier: Column, size: Column, bonuses: Column) -> Column:
    """Of every attack in the series."""
    return F.transform(attack_series(attack), lambda a: attack_total(a, ability, modifier, size, bonuses))


def damage_bonus(ability: Column, modifier: Column, bonuses: Column) -> Column:
    return F.when(ability.isNull(), 0).otherwise(modifier) + F.coalesce(bonuses, F.lit(0))


def skill_total(ranks: Column, modifier: Column, class_skill: Column, bonuses: Column, penalised: Column, penalties: Column) -> Column:
    """Null without ranks or modifier; a class skill with a rank adds its bonus, penalties only where the skill takes them."""
    own = F.when(F.coalesce(class_skill, F.lit(False)) & (ranks > 0), CLASS_SKILL_BONUS).otherwise(0)
    return ranks + modifier + own + F.coalesce(bonuses, F.lit(0)) + F.when(F.coalesce(penalised, F.lit(False)), F.coalesce(penalties, F.lit(0))).otherwise(0)


def class_skill_answers(skills: DataFrame, held: DataFrame, grants: DataFrame) -> DataFrame:
    """owner, skill, granted: true if one of the owner's classes grants the skill, else null if one isn't in the table, else
    false. skills (owner, skill), held (owner, class), grants (class, skill)."""
    known = held.join(grants.select("class").distinct().withColumn("in_table", F.lit(True)), "class", "left")
    granted = known.join(grants, "class").select("owner", "skill", F.lit(True).alias("yes")).distinct()
    unknown = known.groupBy("owner").agg(F.bool_or(F.col("in_table").isNull()).alias("unknown"))
    made = skills.join(granted, ["owner", "skill"], "left").join(unknown, "owner", "left")
    return made.select("owner", "skill", F.when(F.col("yes"), True).when(F.coalesce("unknown", F.lit(True)), F.lit(None)).otherwise(False).alias("granted"))


def class_skill_suggestions(answers: DataFrame, entered: DataFrame) -> DataFrame:
    """owner, skill, suggested: known answers that differ from what was entered (owner, skill, class_skill)."""
    return answers.where("granted IS NOT NULL").join(entered, ["owner", "skill"]).where(~F.col("granted").eqNullSafe(F.col("class_skill"))).select("owner", "skill", F.col("granted").alias("suggested"))


def spell_difficulty(level: Column, modifier: Column, bonuses: Column) -> Column:
    return SPELL_BASE + level + modifier + F.coalesce(bonuses, F.lit(0))


def caster_state(rows: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """rows with ``state``: caster, none, or unknown where the table (class, has_slots) lacks the class."""
    found = rows.join(classes.select(F.col("class").alias(name), "has_slots"), name, "left")
    return found.withColumn("state", F.when(F.col("has_slots").isNull(), "unknown").when(F.col("has_slots"), "caster").otherwise("none")).drop("has_slots")


def bonus_slots(rows: DataFrame, table: DataFrame, modifier: str) -> DataFrame:
    """rows with ``slots`` of their ability modifier (table: modifier, slots) and ``missing`` where the table has none."""
    found = rows.join(table.select(F.col("modifier").alias("__m"), "slots"), F.col(modifier) == F.col("__m"), "left").drop("__m")
    return found.withColumn("missing", F.col("slots").isNull() & F.col(modifier).isNotNull())


def known_spells(rows: DataFrame, owner: str, level: str, known: str) -> DataFrame:
    """owner, level, known, available: sums over classes whose table is of known spells; without one, nothing is available."""
    return rows.groupBy(owner, level).agg(F.sum(known).alias("known"), F.bool_or(F.col(known).isNotNull()).alias("available"))
