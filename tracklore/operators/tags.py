"""Session tags: sorted sets of "<namespace>:<value>" strings. The tags of a session
are put together in operators/trajectories.py."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Model families, by the first name that a model's name holds; and job states that count as success or failure. Fixed values.
FAMILIES = ("opus", "sonnet", "haiku", "kimi", "gpt", "deepseek", "qwen", "llama")
SUCCEEDED = ("completed", "succeeded", "success")
FAILED = ("failed", "error", "timeout", "cancelled")
#: Substrings of outputs that ran out of memory, and of scripts that train. Fixed values.
MEMORY = ("outofmemoryerror", "cuda out of memory", "oom")
TRAINING = ("sftconfig", "sfttrainer", "trainer(", "trainingarguments", "grpo", "dpo", ".train(", "transformers import", "trainer import", "fine-tune", "finetune")


def model_family(name: Column) -> Column:
    low = F.lower(F.coalesce(name, F.lit("")))
    out = F.lit("other")
    for family in reversed(FAMILIES):
        out = F.when(F.contains(low, F.lit(family)), family).otherwise(out)
    return out


def turns_bucket(n: Column) -> Column:
    return F.when(n < 5, "short").when(n <= 20, "medium").otherwise("long")


def cost_bucket(cost: Column) -> Column:
    return F.when(cost < 0.10, "low").when(cost < 1, "med").otherwise("high")


def feedback(up: Column, down: Column) -> Column:
    return F.when((up > 0) & (down > 0), "mixed").when(up > 0, "up").when(down > 0, "down").otherwise("none")


def out_of_memory(output: Column) -> Column:
    """Any of the substrings, of which "oom" is in "room" too."""
    low = F.lower(output)
    return F.coalesce(F.greatest(*(F.contains(low, F.lit(x)) for x in MEMORY)), F.lit(False))


def without_none(tags: Column) -> Column:
    """Drops gpu:none when another gpu tag was seen."""
    gpu = F.size(F.filter(tags, lambda x: F.startswith(x, F.lit("gpu:"))))
    return F.when(gpu > 1, F.array_remove(tags, "gpu:none")).otherwise(tags)
