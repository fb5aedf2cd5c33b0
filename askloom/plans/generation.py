"""Make a source table of tickets for a domain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from askloom.fixed_values import (
    CATEGORY_TEMPLATE,
    DOCUMENT_TEMPLATE,
    MIN_CATEGORIES,
    SYMPTOM_TEMPLATE,
    TICKETS_PER_CATEGORY,
)
from askloom.functions.prompts import render
from askloom.functions.text import letters_only, random_id, short_id, stable_number
from askloom.operators.models import Model, batch_generate
from askloom.sources.tables import ensure_schema, write_new

# Offline wording, used when no model is given.
ORDINALS = [
    "first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth",
]
PLAIN_SYMPTOM = "{category} with the {ordinal} sign of wear"
PLAIN_DOCUMENT = (
    "The operator reports {symptoms}. It may be related to {category}. "
    "Inspection is advised before further use."
)


def propose_categories(
    ask: Model,
    domain: str,
    categories: list[str],
    *,
    minimum: int = MIN_CATEGORIES,
    max_calls: int = 100,
) -> list[str]:
    """A short list of distinct clean category names, asked for one by one on the driver.

    Each request names the categories so far, and there are about ten of them in all. Fewer than
    ``minimum`` after ``max_calls`` requests is an error.
    """
    def clean(name: str) -> str:
        return "".join(c for c in name if c.isascii() and c.isalpha() or c.isspace())

    found = list(dict.fromkeys(clean(c) for c in categories))
    for _ in range(max_calls):
        if len(found) >= minimum:
            break
        prompt = CATEGORY_TEMPLATE.format(text_domain=domain, category_ls=found)
        name = clean(ask([prompt])[0])
        if name and name not in found:
            found.append(name)
    if len(found) < minimum:
        raise RuntimeError(f"{len(found)} categories of {minimum} after {max_calls} requests")
    return found


def _symptoms(categories: DataFrame, domain: str, model: Callable[[], Model] | None) -> DataFrame:
    """Adds the array of symptoms; ``wanted`` says how many."""
    most = TICKETS_PER_CATEGORY[1]
    if model is None:
        numbered = F.transform(
            F.slice(F.array(*[F.lit(o) for o in ORDINALS]), F.lit(1), F.col("wanted")),
            lambda o: render(PLAIN_SYMPTOM, {"category": F.col("category"), "ordinal": o}),
        )
        return categories.withColumn("symptoms", numbered)
    # The i-th request lists the i-1 answers before it: one narrow step per symptom, in which
    # all categories are asked at once. Categories that have enough get a null prompt.
    df = categories.withColumn("symptoms", F.array().cast("array<string>"))
    for i in range(1, most + 1):
        prompt = render(
            SYMPTOM_TEMPLATE,
            {
                "category": F.col("category"),
                "domain": F.lit(domain),
                "symptom_ls": F.to_json("symptoms"),
            },
        )
        df = df.withColumn("_prompt", F.when(F.col("wanted") >= i, prompt))
        df = batch_generate(df, "_prompt", model, out="_symptom").withColumn(
            "symptoms", F.concat("symptoms", F.array_compact(F.array("_symptom")))
        ).drop("_prompt", "_symptom", "tries", "error")
    return df


def generate_tickets(
    categories: DataFrame,
    *,
    domain: str = "",
    model: Callable[[], Model] | None = None,
    seed: int = 0,
    text_col: str = "issue_description",
    id_col: str = "ticket_number",
    random_ids: bool = False,
) -> DataFrame:
    """(category, text, ticket id): 3 to 10 tickets, one per symptom, for each category.

    ``categories`` has a column ``category``; names are reduced to letters and made distinct.
    How many tickets, and their ids, follow from the category and the seed.
    """
    low, high = TICKETS_PER_CATEGORY
    clean = categories.select(letters_only(F.col("category")).alias("category")).distinct()
    wanted = (
        F.lit(low) + stable_number(F.col("category"), F.lit(seed)) % (high - low + 1)
    ).cast("int")
    symptoms = (
        _symptoms(clean.withColumn("wanted", wanted), domain, model)
        .withColumn("symptoms", F.array_distinct(F.transform("symptoms", letters_only)))
        .select("category", F.explode("symptoms").alias("symptom"))
    )
    variables = {"symptoms": F.col("symptom"), "category": F.col("category")}
    if model is None:
        texts = symptoms.withColumn(text_col, render(PLAIN_DOCUMENT, variables))
    else:
        prompts = symptoms.withColumn("_prompt", render(DOCUMENT_TEMPLATE, variables))
        texts = batch_generate(prompts, "_prompt", model, out=text_col)
    ticket = random_id() if random_ids else short_id(
        F.col("category"), F.col("symptom"), F.lit(seed).cast("string")
    )
    return texts.select("category", text_col, ticket.alias(id_col))


def generate_source(
    spark: SparkSession,
    table: str,
    categories: DataFrame | list[str],
    *,
    domain: str = "",
    model: Callable[[], Model] | None = None,
    minimum: int = MIN_CATEGORIES,
    **options,
) -> DataFrame:
    """Make the source table ``table``, which must not exist yet, and read it back.

    ``categories`` are a table with a column ``category``, or a few names, which the model completes to
    ``minimum`` of them. The schema of the table is created where it is missing.
    """
    if not isinstance(categories, DataFrame):
        if model is not None:
            categories = propose_categories(model(), domain, categories, minimum=minimum)
        categories = spark.createDataFrame([(c,) for c in categories], "category string")
    if "." in table:
        ensure_schema(spark, table.rsplit(".", 1)[0])
    write_new(generate_tickets(categories, domain=domain, model=model, **options), table)
    return spark.read.table(table)
