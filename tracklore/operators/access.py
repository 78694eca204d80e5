"""Plans, paid organisations and the namespaces that may own a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklore.operators.rules import first_given

#: Substrings of a plan's name that pay. Fixed values.
PAID = ("pro", "enterprise", "team")


def _pays(plan: Column) -> Column:
    low = F.lower(F.coalesce(plan, F.lit("")))
    return F.greatest(*(F.contains(low, F.lit(x)) for x in PAID))


def personal_plan(plan: Column, kind: Column, account: Column, is_pro: Column) -> Column:
    """pro or free, by the first of three names that is given, or else by the flag."""
    named = first_given(plan, kind, account)
    return F.when(F.when(named.isNull(), F.coalesce(is_pro, F.lit(False))).otherwise(_pays(named)), "pro").otherwise("free")


def paid_orgs(orgs: Column) -> Column:
    """Sorted names of the organisations (name, plan, type) that pay."""
    paying = F.filter(orgs, lambda o: (F.coalesce(o["name"], F.lit("")) != "") & _pays(first_given(o["plan"], o["type"])))
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(paying, lambda o: o["name"]))), F.array().cast("array<string>"))


def plan_tier(personal: Column, paid: Column) -> Column:
    return F.when(personal == "pro", "pro").when(F.size(paid) > 0, "org").otherwise("free")


def eligible_namespaces(user: Column, personal: Column, paid: Column) -> Column:
    own = F.when((personal == "pro") & (F.coalesce(user, F.lit("")) != ""), F.array(user)).otherwise(F.array().cast("array<string>"))
    return F.concat(own, paid)


def namespace(requested: Column, user: Column, personal: Column, paid: Column, known: Column | None = None) -> Column:
    """struct(namespace, problem): the namespace that owns a job, or why there is none: not_allowed, namespace_required or
    upgrade_required. Where access is not known, nothing is held back: the requested one, else the user, else no_token."""
    asked, name = F.nullif(requested, F.lit("")), F.nullif(user, F.lit(""))
    eligible = eligible_namespaces(user, personal, paid)
    default = F.when(personal == "pro", name)
    inside = F.when(asked.isNotNull(), F.when(F.array_contains(eligible, asked), asked)).otherwise(default)
    problem = F.when(inside.isNotNull(), F.lit(None)).when(asked.isNotNull(), "not_allowed").when(F.size(paid) > 0, "namespace_required").otherwise("upgrade_required")
    if known is None:
        return F.struct(inside.alias("namespace"), problem.alias("problem"))
    fallback = F.when(name.isNotNull(), F.coalesce(asked, name))
    return F.struct(F.when(known, inside).otherwise(fallback).alias("namespace"), F.when(known, problem).otherwise(F.when(fallback.isNull(), "no_token")).alias("problem"))


def is_member(orgs: Column, name: Column) -> Column:
    return F.coalesce(F.array_contains(orgs, name), F.lit(False))


def normalised_user(sub: Column, preferred: Column) -> Column:
    """struct(user_id, username), the unknown user where nothing names one."""
    return F.struct(F.coalesce(sub, preferred, F.lit("unknown")).alias("user_id"), F.coalesce(preferred, F.lit("unknown")).alias("username"))
