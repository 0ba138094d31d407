"""Ledgers, and the event registers kept in the old database."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.predicates import min_len, route
from ledgerloom.functions.text import agents_with_roles, empty_to_null, map_values, null_after, to_int, unreadable_number
from ledgerloom.operators.joins import decode
from ledgerloom.operators.shape import copy_positional
from ledgerloom.plans.base import JobResult, Sources, fill, numbered, seed
from ledgerloom.plans.fixed import ARTICLE_WORDS, DELETED, SALE_UNITS, TRANSACTION_DIRECTIONS, UNCHANGED_TABLES
from ledgerloom.plans.schemas import schema
from ledgerloom.sources.counted import listed_reasons, load
from ledgerloom.sources.tables import lookup

# Old and new column names.
TRANSACTION_COLUMNS = {
    "transaction_code": "transaction_code",
    "order_code": "order_code",
    "page_or_folio_numbers": "page_or_folio_numbers",
    "account_heading": "account_heading",
    "direction": "direction",
    "transaction_description": "direction_of_transaction",
    "work_code": "super_book_code",
    "edition_code": "book_code",
    "stn_abbreviated_title": "stn_abbreviated_title",
    "total_number_of_volumes": "total_number_of_volumes",
    "notes": "notes",
}
STAMPING_COLUMNS = {
    "ID": "ID",
    "stamped_edition": "ID_EditionName",
    "permitted_dealer": "ID_DealerName",
    "attending_inspector": "ID_AgentA",
    "attending_adjoint": "ID_AgentB",
    "stamped_at_place": "ID_PlaceName",
    "stamped_at_location_type": "EventLocation",
    "copies_stamped": "EventCopies",
    "volumes_stamped": "EventVols",
    "date": "EventDate",
    "ms_number": "ID_Archive",
    "folio": "EventFolioPage",
    "citation": "EventCitation",
    "page_stamped": "EventPageStamped",
    "edition_notes": "EventNotes",
    "event_notes": "EventOther",
    "article": "EventArticle",
    "date_entered": "DateEntered",
    "entered_by_user": "EventUser",
}
BANNED_COLUMNS = {
    "UUID": "UUID",
    "work_code": "illegal_super_book_code",
    "title": "illegal_full_book_title",
    "author": "illegal_author_name",
    "date": "illegal_date",
    "folio": "illegal_folio",
    "notes": "illegal_notes",
}
BASTILLE_COLUMNS = {
    "UUID": "UUID",
    "work_code": "illegal_super_book_code",
    "title": "illegal_full_book_title",
    "author_name": "illegal_author_name",
    "imprint": "bastille_imprint_full",
    "publication_year": "illegal_date",
    "copies_found": "bastille_copies_number",
    "current_volumes": "bastille_current_volumes",
    "total_volumes": "bastille_total_volumes",
    "category": "bastille_book_category",
    "notes": "illegal_notes",
}
SALE_COLUMNS = {
    "ID": "ID",
    "auction_id": "ID_Sale_Agent",
    "purchaser": "ID_DealerName",
    "purchased_edition": "ID_EditionName",
    "sale_type": "sale_type",
    "units_sold": "EventCopies",
    "units": "units",
    "volumes_traded": "EventVols",
    "lot_price": "EventLotPrice",
    "date": "EventDate",
    "folio": "EventFolioPage",
    "citation": "EventCitation",
    "article_number": "EventArticle",
    "edition_notes": "EventNotes",
    "event_notes": "EventOther",
    "sale_notes": "EventMoreNotes",
}


def unchanged(src: Sources, tables: dict[str, str]) -> JobResult:
    """Copies of tables that keep their shape: {target: source}; most gain a row number."""
    result = JobResult()
    for target, source in tables.items():
        copied = copy_positional(src[source], schema(target))
        if "ID" in schema(target).names:
            result.tables[target] = numbered(target, copied, copied.columns)
        else:
            result.tables[target] = fill(target, copied)
    return result


def transactions(src: Sources) -> JobResult:
    """Ledger entries with the direction that their wording stands for."""
    t = src["transactions"]
    directions = lookup(t.sparkSession, TRANSACTION_DIRECTIONS, "wording string, direction int")
    coded = decode(t, directions, "direction_of_transaction", "wording", {"direction": "direction"}, ci=True)
    renamed = coded.select(*[F.col(c).alias(n) for n, c in TRANSACTION_COLUMNS.items()])
    others = [c for c in renamed.columns if c not in ("order_code", "transaction_code")]
    return JobResult(
        {"stn_transaction": numbered("stn_transaction", renamed, ["order_code", "transaction_code", *others])}
    )


def clients(src: Sources) -> JobResult:
    """Clients with parsed first and last dates."""
    copied = copy_positional(src["clients"], schema("stn_client"))
    dated, lost = copied, []
    for column in ("first_date", "last_date"):
        lost.append(f"_lost_{column}")
        dated = dates.add_english_date(dated, column, column, reject=lost[-1])
    loaded = load(dated, listed_reasons(dates.ENGLISH_REASONS, *lost), lambda df: fill("stn_client", df), "clients-dated")
    return JobResult({"stn_client": loaded.df}, {"client dates": loaded.rejects})


def ledgers(src: Sources) -> JobResult:
    return unchanged(src, UNCHANGED_TABLES).merge(transactions(src)).merge(clients(src))


def registers(src: Sources) -> JobResult:
    """Stampings, banned list, prison register, auctions with administrators, and sales."""
    events = src["manuscript_events"]
    counts = ("EventCopies", "EventVols")
    stamping = load(
        events,
        {"not a number": [unreadable_number(c) for c in counts]},
        lambda df: fill("stamping", df.withColumns({c: to_int(empty_to_null(c)) for c in counts}), STAMPING_COLUMNS),
        "stamping",
    )

    illegal = src["manuscript_titles_illegal"].withColumn(
        "illegal_date", dates.year_to_partial(null_after("illegal_date", dates.NO_DATE))
    )
    category = F.col("bastille_book_category")
    targets = route(
        illegal,
        {
            "banned": (F.upper("record_status") != DELETED) & (F.rtrim(category) == ""),
            "bastille": min_len(category, 1),
        },
    )
    banned = targets["banned"].select(*[F.col(c).alias(n) for n, c in BANNED_COLUMNS.items()])
    bastille = targets["bastille"].select(*[F.col(c).alias(n) for n, c in BASTILLE_COLUMNS.items()])

    sold = src["manuscript_sales_events"]
    auctions = fill(
        "parisian_stock_auction",
        sold,
        {
            "auction_id": "salesNumber",
            "ms_number": "msNumber",
            "previous_owner": "Client_Code",
            "auction_reason": "code",
            "place": "Place_Code",
        },
    )
    agents = agents_with_roles(
        sold.withColumnRenamed("salesNumber", "auction_id"), "ID_Agent", ["auction_id"], "administrator_id", "role"
    )
    with_role = decode(agents, seed(sold, "auction_role"), "role", "role", {"administrator_role": "ID"})
    administrators = load(
        with_role,
        {"unknown role": [F.col("role").isNotNull() & F.col("administrator_role").isNull()]},
        lambda df: fill("auction_administrator", df),
        "administrators",
    )

    sales = src["manuscript_events_sales"]
    typed = decode(sales, seed(sales, "sale_type"), "EventType", "type", {"sale_type": "ID"}, ci=True)
    article = F.lower("EventArticle")
    typed = typed.withColumns(
        {
            "units": map_values(F.lower("EventCopiesType"), SALE_UNITS),
            "EventArticle": map_values(article, ARTICLE_WORDS, to_int(empty_to_null("EventArticle"))),
            "EventDate": empty_to_null("EventDate"),
        }
    )
    return JobResult(
        {
            "stamping": stamping.df,
            "banned_list_record": numbered("banned_list_record", banned, banned.columns),
            "bastille_register_record": numbered("bastille_register_record", bastille, bastille.columns),
            "parisian_stock_auction": auctions,
            "auction_administrator": administrators.df,
            "parisian_stock_sale": fill("parisian_stock_sale", typed, SALE_COLUMNS),
        },
        {"stamping counts": stamping.rejects, "auction roles": administrators.rejects},
    )
