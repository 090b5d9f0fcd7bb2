"""Clinical classification rules as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnLike, column, first_of

# Category names and their keywords. The order of rules matters, the first match wins.
CONDITION_RULES = {
    "Endocrine / Metabolic": ["diabetes", "insulin", "retinopathy", "microalbuminuria"],
    "Cardiology": ["cardiac arrest", "hypertension"],
    "Trauma / Musculoskeletal": [
        "fracture", "injury", "sprain", "concussion", "osteoarthritis", "meniscus", "laceration",
        "rupture of patellar", "thigh", "hand", "foot", "burn", "wound", "rupture", "bullet",
    ],
    "Oncology": ["cancer", "neoplasm", "tumor", "carcinoma"],
    "Respiratory": [
        "asthma", "bronchitis", "sinusitis", "copd", "pneumonia", "emphysema", "pharyngitis",
        "sore throat", "bronch",
    ],
    "Rheumatology": ["rheumatoid", "gout", "fibromyalgia"],
    "ENT / Allergy": ["rhinitis", "otitis", "allergic reaction"],
    "Neurological": ["migraine", "stroke", "brain", "paralysis", "alzheimer", "dementia"],
    "Mental / Behavioral": ["attention deficit", "adhd", "autism"],
    "Reproductive / Obstetrics": ["pregnancy", "miscarriage", "eclampsia", "infertility", "uterine", "ovum"],
    "Urology / Nephrology": ["urinary", "kidney", "renal", "cystitis", "pyelonephritis"],
    "Gastroenterology": ["appendicitis", "bleeding from anus", "colon", "diarrhea", "rectal", "polyp"],
    "Post-surgical History": [
        "history of appendectomy", "history of amputation", "history of cardiac arrest",
    ],
    "Toxicology": ["overdose"],
}
OTHER = "Other"


def lower_contains(text: ColumnLike, keywords: list[str]) -> Column:
    """True when the lower-cased text holds any of the keywords."""
    return contains_any(F.lower(column(text)), keywords)


def contains_any(text: Column, keywords: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(word) for word in keywords))


def categorize_keywords(text: ColumnLike, rules: dict[str, list[str]], default: str = OTHER) -> Column:
    """First rule with a keyword inside the text; text that matches none, or is NULL, gets the default."""

    def chosen(lowered: Column) -> Column:
        choice = F
        for label, keywords in rules.items():
            choice = choice.when(contains_any(lowered, keywords), F.lit(label))
        return choice.otherwise(F.lit(default))

    # a lambda's argument is computed once, however many tests use it
    return F.get(F.transform(F.array(F.lower(column(text))), chosen), F.lit(0))


def condition_category(display: ColumnLike) -> Column:
    return categorize_keywords(display, CONDITION_RULES)


def dosage_class(dosages: ColumnLike) -> Column:
    """An empty list means no instructions; a missing list counts as scheduled."""
    doses = column(dosages)
    return (
        F.when(F.size(doses) == 0, "no instructions")
        .when(first_of(doses)["asNeededBoolean"], "as needed")
        .otherwise("scheduled")
    )


def dosage_class_of_flag(as_needed: ColumnLike) -> Column:
    """The same from one dosage's flag: without a flag there are no instructions."""
    flag = column(as_needed)
    return F.when(flag.isNull(), "no instructions").when(flag, "as needed").otherwise("scheduled")


def multiple_birth(flag: ColumnLike, order: ColumnLike) -> Column:
    """One integer for twins and more: the flag as 0/1, or the birth order when no flag is given."""
    return F.coalesce(column(flag).cast("bigint"), column(order)).cast("int")
