"""Works with their categories and keywords, editions, and places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import min_len, not_null_word
from ledgerloom.functions.text import comma_items, fold_name, to_int
from ledgerloom.operators.codes import repair_codes
from ledgerloom.operators.crosswalk import Crosswalk, one_to_one, recode
from ledgerloom.operators.joins import missing_from, resolve_pair, update_matched
from ledgerloom.operators.merge import first_by, unique_rows
from ledgerloom.operators.shape import assemble, copy_positional
from ledgerloom.plans.base import JobResult, Options, Sources, fill, numbered, sheet
from ledgerloom.plans.fixed import KEYWORD_CODE_LENGTH, KEYWORD_PREFIX
from ledgerloom.plans.schemas import schema
from ledgerloom.session import store
from ledgerloom.sources.tables import pick

# Old and new column names.
EDITION_COLUMNS = {
    "edition_code": "book_code",
    "work_code": "super_book_code",
    "edition_status": "edition_status",
    "edition_type": "edition_type",
    "full_book_title": "full_book_title",
    "short_book_titles": "short_book_titles",
    "translated_title": "translated_title",
    "translated_language": "translated_language",
    "languages": "languages",
    "imprint_publishers": "stated_publishers",
    "actual_publishers": "actual_publishers",
    "imprint_publication_places": "stated_publication_places",
    "actual_publication_places": "actual_publication_places",
    "imprint_publication_years": "stated_publication_years",
    "actual_publication_years": "actual_publication_years",
    "pages": "pages",
    "quick_pages": "quick_pages",
    "number_of_volumes": "number_of_volumes",
    "section": "section",
    "edition": "edition",
    "book_sheets": "book_sheets",
    "notes": "notes",
    "research_notes": "research_notes",
}
# Columns of the sheet of new places, by position.
NEW_PLACE_COLUMNS = [
    "place_code", "name", "alternative_names", "C18_lower_territory", "C18_sovereign_territory", "C21_admin",
    "C21_country", "geographic_zone", "BSR", "EL", "HRE", "IFC", "P", "HE", "HT", "WT", "PT", "PrT",
    "distance_from_neuchatel", "latitude", "longitude", "geoname", "notes",
]


def _associations(target: str, pairs: DataFrame, names, key: list[str]) -> DataFrame:
    resolved = resolve_pair(
        pairs, names, "name", "code", {"keyword": "keyword_1", "association": "keyword_2"}, ci=True
    )
    return numbered(target, unique_rows(resolved.select(*key), key, key), key)


def works(src: Sources) -> JobResult:
    books = src["manuscript_books"]
    work = fill(
        "work",
        books,
        {
            "work_code": "super_book_code",
            "work_title": "super_book_title",
            "parisian_keyword": "parisian_keyword",
            "illegality_notes": "illegality",
        },
    )
    fuzzy = src["manuscript_cat_fuzzy"].filter(not_null_word("fuzzyValue"))
    fuzzy = first_by(
        fuzzy.select("super_book_code", "fuzzyValue", "fuzzyComment"), ["super_book_code"], ["fuzzyValue"]
    )
    work = update_matched(
        work,
        fuzzy,
        {"work_code": "super_book_code"},
        {"categorisation_fuzzy_value": to_int("fuzzyValue"), "categorisation_notes": F.col("fuzzyComment")},
        hot=None,
    )

    repaired = repair_codes(src["keywords"], "keyword_code", KEYWORD_CODE_LENGTH, KEYWORD_PREFIX)
    keyword_map: Crosswalk = one_to_one(repaired, "old_code", "new_code")
    keyword = fill("keyword", recode(src["keywords"], keyword_map, ["keyword_code"]))

    listed = books.filter(min_len("keywords", 1)).select(
        F.col("super_book_code").alias("work_code"), F.posexplode(comma_items("keywords")).alias("_pos", "keyword_code")
    )
    work_keyword = numbered(
        "work_keyword", recode(listed, keyword_map, ["keyword_code"]), ["work_code", "_pos", "keyword_code"]
    )

    by_name = keyword.groupBy(fold_name("keyword").alias("name")).agg(F.min("keyword_code").alias("code"))
    names = store(by_name, "keyword-names")
    key = ["keyword_1", "keyword_2"]
    return JobResult(
        {
            "work": work,
            "keyword": keyword,
            "work_keyword": work_keyword,
            "parisian_category": fill(
                "parisian_category", copy_positional(src["parisian_keywords"], schema("parisian_category"))
            ),
            "tag": fill("tag", copy_positional(src["tags"], schema("tag"))),
            "keyword_free_association": _associations(
                "keyword_free_association", src["keyword_free_associations"], names, key
            ),
            "keyword_tree_association": _associations(
                "keyword_tree_association", src["keyword_tree_associations"], names, key
            ),
        }
    )


def editions(src: Sources) -> JobResult:
    return JobResult({"edition": fill("edition", src["manuscript_books_editions"], EDITION_COLUMNS)})


def places(src: Sources, options: Options = Options()) -> JobResult:
    """Known places, and those of the sheet whose code is new."""
    known = fill("place", src["places"])
    listed = pick(sheet(src, "new_places", options), dict(enumerate(NEW_PLACE_COLUMNS)))
    added = missing_from(listed, known, {"place_code": "place_code"}, hot=None)
    return JobResult({"place": assemble(schema("place"), [known, added])})
