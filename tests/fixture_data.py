"""Small invented sources for the jobs: tables of the old database and sheet extracts."""

from __future__ import annotations


def strings(names: str) -> str:
    return ", ".join(f"`{n}` string" for n in names.split())


def wide(width: int, rows: list[dict], typed: dict[int, str] | None = None):
    """A sheet of `width` columns with values in the given places; sheet row numbers start at 2."""
    typed = typed or {}
    ddl = "_row bigint, " + ", ".join(f"c{i} {typed.get(i, 'string')}" for i in range(width))
    return ddl, [(n + 2, *[r.get(i) for i in range(width)]) for n, r in enumerate(rows)]


EDITION = "book_code super_book_code edition_status edition_type full_book_title short_book_titles translated_title translated_language languages stated_publishers actual_publishers stated_publication_places actual_publication_places stated_publication_years actual_publication_years pages quick_pages"

TABLES = {
    "manuscript_books": (
        strings("super_book_code super_book_title parisian_keyword illegality keywords"),
        [
            ("spbk0000001", "Candide", "pk1", None, "k0001, kx"),
            ("spbk0000002", "Emile", "pk2", "banned", "k"),
            ("spbk0000003", "Zadig", None, None, "k0007 ,k9999"),
            ("spbk0000004", "Manon", None, None, None),
        ],
    ),
    "manuscript_cat_fuzzy": (
        strings("super_book_code fuzzyValue fuzzyComment"),
        [("spbk0000001", "3", "seen"), ("spbk0000002", "NULL", "lost"), ("spbk0000003", None, "lost too")],
    ),
    "keywords": (
        strings("keyword_code keyword definition tag_code"),
        [
            ("k0001", "Satire", "d1", "t01"),
            ("k0007", "Education", "d2", "t02"),
            ("kx", "Philosophy", "d3", "t01"),
            ("k10", "Novel", "d4", None),
        ],
    ),
    "parisian_keywords": (strings("a b c d e"), [("pk1", "Romans", None, None, None), ("pk2", "Arts", "pk1", None, None)]),
    "tags": (strings("a b c"), [("t01", "Genre", "x"), ("t02", "Subject", "y")]),
    "keyword_free_associations": (
        strings("keyword association"),
        [("satire", "Philosophy"), ("Satire", "Philosophy"), ("Nobody", "Noone"), ("Nobody", "Noone"), ("Novel", "Nobody")],
    ),
    "keyword_tree_associations": (strings("keyword association"), [("Novel", "Satire")]),
    "manuscript_books_editions": (
        strings(EDITION) + ", number_of_volumes int, " + strings("section edition book_sheets notes research_notes"),
        [
            ("bk0000000001", "spbk0000001", "s1", "t1", "Candide 1759", *[None] * 7, "Geneva", "1759", "1759", "300", "300p", 1, None, None, None, "n", None),
            ("bk0000000002", "spbk0000002", "s2", "t2", "Emile 1762", *[None] * 7, "Paris", "1762", "1762", None, None, 4, None, None, None, None, None),
        ],
    ),
    "places": (
        strings("place_code name alternative_names town C18_lower_territory C18_sovereign_territory C21_admin C21_country geographic_zone BSR")
        + ", HRE boolean, EL boolean, IFC boolean, P boolean, HE boolean, HT boolean, WT boolean, PT boolean, PrT boolean, distance_from_neuchatel double, latitude decimal(10,8), longitude decimal(10,8), geoname int, notes string",
        [
            ("pl001", "Paris", None, "Paris", *[None] * 6, True, *[None] * 8, 420.5, None, None, 1, None),
            ("pl002", "Lyon", *[None] * 8, *[None] * 9, 290.0, None, None, 2, None),
            ("pl003", "lyon", *[None] * 8, *[None] * 9, None, None, None, 3, "same name"),
        ],
    ),
    "clients_professions": (strings("a b"), [("cl0001", "pf001"), ("cl0002", "pf002")]),
    "books_call_numbers": (strings("a b"), [("bk0000001", "X 1")]),
    "books_stn_catalogues": (strings("a b"), [("bk0000001", "cat 1")]),
    "clients_correspondence_manuscripts": ("a string, b int, c string", [("cl0001", 1, "ms 1")]),
    "clients_correspondence_places": (strings("a b c"), [("cl0001", "pl001", "1770")]),
    "orders_agents": (strings("a b c"), [("or0000001", "cl0001", "pl001")]),
    "orders_sent_via": (strings("a b c"), [("or0000001", "cl0002", None)]),
    "orders_sent_via_place": (strings("a b"), [("or0000001", "pl002"), ("or0000001", "pl001")]),
    "transactions_volumes_exchanged": ("a string, b string, c int, d int", [("tr0000001", "or0000001", 1, 10)]),
    "orders": (strings("a b c d e f g") + ", h boolean", [("or0000001", "cl0001", "pl001", "1770", "m", "t", "b", True)]),
    "transactions": (
        strings("transaction_code order_code page_or_folio_numbers account_heading direction_of_transaction super_book_code book_code stn_abbreviated_title")
        + ", total_number_of_volumes int, notes string",
        [
            ("tr0000001", "or0000001", "1", "h", "IN (Printing)", "spbk0000001", "bk0000000001", "Cand.", 10, None),
            ("tr0000002", "or0000001", "1", "h", "out", "spbk0000002", "bk0000000002", "Em.", 2, None),
            ("tr0000003", "or0000001", "2", "h", "in (rétiré)", None, None, None, None, None),
            ("tr0000004", "or0000001", "2", "h", "unheard of", None, None, None, None, None),
        ],
    ),
    "clients": (
        "client_code string, client_name string, has_correspondence boolean, partnership boolean, gender string, data_source string, option_menu_type string, number_of_letters smallint, number_of_documents smallint, first_date string, last_date string, notes string",
        [
            ("cl0001", "Bergeret", True, False, "M", "db", "m", 1, 2, "5th May 1785", "12 July 1786", "stn one"),
            ("cl0002", "Freres Detournes", True, True, "mixed", "db", "m", 1, 2, "May 1785", "", None),
            ("cl0003", "Buchet", False, None, "Female", "db", "m", None, None, None, "3 About 1785", "stn three"),
            ("cl0004", "null", False, None, None, "db", "m", None, None, None, None, None),
            ("cl0005", "Maison Cie", True, True, None, "db", "m", None, None, None, "31 Feb 1785", None),
        ],
    ),
    "manuscript_events": (
        "ID int, " + strings("ID_EditionName ID_DealerName ID_AgentA ID_AgentB ID_PlaceName EventLocation EventCopies EventVols EventDate ID_Archive EventFolioPage EventCitation EventPageStamped EventNotes EventOther EventArticle DateEntered EventUser"),
        [
            (1, "bk0000000001", "cl0001", "cl0003", None, "pl001", "shop", "12", "", "1778-01-02", "ms", "f", "c", "p", None, None, None, "x", "u"),
            (2, "bk0000000002", "cl9999", None, None, "pl002", "shop", "", "many", "1778-01-03", "ms", "f", "c", "p", None, None, None, "x", "u"),
        ],
    ),
    "manuscript_titles_illegal": (
        strings("UUID illegal_super_book_code illegal_full_book_title illegal_author_name illegal_date illegal_folio illegal_notes record_status bastille_book_category bastille_imprint_full bastille_copies_number bastille_current_volumes bastille_total_volumes"),
        [
            ("u1", "spbk0000001", "Candide", "V.", "1770", "1r", None, "OK", "", None, None, None, None),
            ("u2", "spbk0000002", "Emile", "R.", "no date available", "2r", None, "OK", "", None, None, None, None),
            ("u3", "spbk0000003", "Zadig", "V.", "1771", "3r", None, "DELETED", "", None, None, None, None),
            ("u4", "spbk0000004", "Manon", "P.", "", "4r", None, "DELETED", "contrefait", "imp", "3", "1", "2"),
            ("u5", "spbk0000004", "Manon", "P.", "1772", "4r", None, "OK", "x", None, None, None, None),
            ("u6", "spbk0000004", "Manon", "P.", "1773", "4r", None, None, "", None, None, None, None),
        ],
    ),
    "manuscript_sales_events": (
        "salesNumber string, msNumber int, Client_Code string, code int, Place_Code string, ID_Agent string",
        [
            ("s0001", 1, "cl0001", 1, "pl001", "cl0003 (Adjoint), cl0001, cl0004 (Mayor)"),
            ("s0002", 2, "cl7777", 2, "pl001", "cl0002 (Syndic)"),
        ],
    ),
    "manuscript_events_sales": (
        "ID int, " + strings("ID_Sale_Agent ID_DealerName ID_EditionName EventType EventCopies EventCopiesType EventVols EventLotPrice EventDate EventFolioPage EventCitation EventArticle EventNotes EventOther EventMoreNotes"),
        [
            (1, "s0001", "cl0003", "bk0000000001", "stock sale", "2", "copies", None, "3 livres", "", None, None, "t8", None, None, None),
            (2, "s0001", None, "bk0000000002", "Sale of Privilege", "1", "Privilege", None, None, "1779-05-01", None, None, "", None, None, None),
            (3, "s0002", "cl8888", None, "other", "1", "box", None, None, "1779-05-02", None, None, "17", None, None, None),
        ],
    ),
    "people": (
        strings("person_code person_name sex title other_names designation status birth_date death_date notes"),
        [
            ("id0001", "Bergeret, Paul", "M", None, None, None, None, "1 January 1740", "1800", "born in Paris"),
            ("id0002", "Detournes, Jean", "M", "Sieur", None, None, None, None, None, None),
            ("id0009", "Autre", None, None, None, None, None, None, None, None),
        ],
    ),
    "clients_people": (
        strings("client_code person_code"),
        [("cl0001", "id0001"), ("cl0001", "id0009"), ("cl0002", "id0002"), ("cl0005", "id0009")],
    ),
    "people_professions": (strings("person_code profession_code"), [("id0001", "pf001"), ("id0002", "pf001")]),
    "professions": (strings("a b c d e"), [("pf001", "Libraire", "Bookseller", "g", "s"), ("pf014", "Auteur", "Author", "g", "s")]),
    "manuscript_authors": (
        strings("author_code author_name"),
        [("au001", "Voltaire"), ("au002", "Rousseau"), ("au003", "Rousseau"), ("au004", "Prevost"), ("au004", "Prevost d'Exiles")],
    ),
    "manuscript_books_authors": (
        strings("book_code author_code author_type") + ", certain int",
        [
            ("bk0000000001", "au001", "primary", 1),
            ("bk0000000002", "au001", "Secondary", 1),
            ("bk0000000002", "au002", "Primary", 1),
            ("bk0000000002", "au003", "Translator", 0),
            ("bk0000000002", "au999", "Primary", 0),
        ],
    ),
    "manuscript_dealers": (
        strings("Client_Code Dealer_Name Alternative_Name Profession_Code Place_Code Notes"),
        [
            ("cl0001", "Bergeret l'aine", None, "pf001", "pl001", "dealer note"),
            ("cl0003", "Buchet", None, None, None, None),
            ("cl0100", "Durand", "Durand neveu", "pf001, pf014;  pf001", "pl001; pl002", "new dealer"),
        ],
    ),
    "manuscript_agents_inspectors": (
        strings("Client_Code Agent_Name Place_Code Notes"),
        [("cl0003", "Buchet", None, "inspector note"), ("cl0200", "Goy", "pl002", None)],
    ),
    "clients_addresses": (
        strings("client_code place_code address"),
        [("cl0001", "pl001", "rue A"), ("cl0100", "pl001", "rue B"), ("cl9999", "pl002", "nowhere")],
    ),
}

SHEETS = {
    "new_places": wide(
        23,
        [{0: "pl001", 1: "Paris again"}, {0: "pl010", 1: "Metz"}],
        {8: "string", **{i: "boolean" for i in range(9, 18)}, 18: "double", 19: "decimal(10,8)", 20: "decimal(10,8)", 21: "int"},
    ),
    "confiscations_master": wide(
        46,
        [
            {0: 1, 1: 21933, 2: "1r", 3: "21,914", 6: "1771-02-03", 9: "yes", 11: "Durand; Goy; Anon", 12: "cl0100; cl0200",
             17: "null text", 18: "cl0100", 20: "Censor B;Censor A", 21: "cl0003;cl0100", 24: "Buchet", 25: "cl0003", 27: "Bergeret", 29: "cl0001",
             32: "cl0100", 33: "Lyon", 34: "pl002, pl001", 36: "null", 38: "cl0200", 42: "n", 44: "7"},
            {0: 2, 3: "abc", 9: "nope", 11: "Ghost", 12: "cl6666", 24: "Ghost; Durand", 25: "cl6666; cl0100", 34: "pl001"},
            {0: 3, 9: "maybe"},
            {1: 99, 2: "after the blank row"},
            {0: 4, 2: "never read"},
        ],
        {0: "int", 1: "int"},
    ),
    "licences": wide(
        14,
        [
            {0: 1, 1: 1, 2: "12 July 1779", 3: "bk0000000001", 6: "cl0100", 10: 100, 11: 90, 12: "yes", 13: "no"},
            {0: 2, 1: 1, 2: "July 1779", 3: "bk0000000009", 6: "cl0404", 12: "probable", 13: "sure"},
        ],
        {0: "int", 1: "int", 10: "int", 11: "int"},
    ),
    "permission_editions": wide(
        30,
        [
            {0: "bk0000000001", 1: "changed", 15: "1760", 16: "1760", 19: "2 vols", 27: "first"},
            {0: "bk0000000009", 1: "new", 4: "Zadig 1750", 15: "1750", 19: "2", 29: "http://x"},
            {0: "bk0000000009", 1: "newer", 4: "Zadig 1751", 15: "1751", 19: None, 29: None},
        ],
    ),
    "condemnations": wide(
        6,
        [
            {0: "1r", 1: "Candide", 3: "Parlement", 4: "3/5/1785; 14/12/1786"},
            {0: "2r", 1: "Emile", 4: "1/2/3/4"},
            {0: "3r", 1: "Zadig", 4: "5/1785"},
            {0: "4r", 1: "Manon"},
        ],
    ),
    "sample_orders": wide(
        11,
        [
            {0: "Candide", 1: "8", 2: "1", 4: "13", 5: "??/05/1770", 7: 1, 8: "Bergeret"},
            {0: "Emile", 1: "8", 2: "4", 4: "2", 5: "12/ 05/1770", 7: 2, 8: "Somebody"},
        ],
        {7: "int"},
    ),
    "provincial_inspections": wide(
        23,
        [
            {0: "ms", 1: "1", 2: "LYON", 3: 1, 4: "1785-01-01", 8: "Paris", 10: "Candide", 18: 3},
            {0: "ms", 1: "2", 2: "Nowhere", 3: 2, 8: None, 10: "Emile", 18: 1},
        ],
        {3: "int", 18: "int"},
    ),
    "new_professions_permission": wide(4, [{0: "Imprimeur", 1: "pf020"}, {1: "pf021"}, {0: "Libraire", 1: "pf001"}]),
    "new_professions_consignments": wide(4, [{0: "Imprimeur bis", 1: "pf020"}, {0: "Relieur", 1: "pf022"}]),
    "author_person": wide(
        9, [{0: "id000001", 3: "au001", 7: "Y"}, {0: "id000002", 3: "au002", 7: "N"}, {0: "id000009", 3: "au001", 7: "Y"}]
    ),
    "people_final": wide(
        12,
        [
            {2: " Goy ", 3: "cl0200", 4: "conf note", 10: "male", 11: "no"},
            {2: "Veuve Roy", 3: "cl0300 ", 4: "widow", 5: "Veuve ", 7: "pl002", 9: "pf020", 10: "Female", 11: "no"},
            {2: "Second Roy", 3: "cl0300", 4: "dropped", 10: "male", 11: "yes"},
            {2: "Roy et Cie", 3: "cl0301", 10: "mixed", 11: "perhaps"},
            {2: "blank code"},
            {2: "unseen", 3: "cl0999"},
        ],
    ),
    "permission_clients": wide(
        9, [{0: "cl0300", 1: "Roy", 3: "F", 8: "perm note"}, {0: "cl0400", 1: "Nouveau", 2: "N.", 3: "M", 5: "pf001", 7: "pl001", 8: None}]
    ),
    "clients_without_person_codes": wide(
        5,
        [
            {0: "cl0002", 1: "Freres Detournes", 3: "Y", 4: "firm"},
            {0: "cl0003", 1: "Buchet", 2: "Y", 3: "Y"},
            {0: "cl0004", 1: "skipped"},
        ],
    ),
}


def sources(spark) -> dict:
    return {n: spark.createDataFrame(rows, ddl) for n, (ddl, rows) in {**TABLES, **SHEETS}.items()}
