"""The jobs on small invented sources, chained as in a full rebuild."""

import pytest

from fixture_data import sources
from ledgerloom.plans.agents import agent_professions, merged_clients
from ledgerloom.plans.base import Options
from ledgerloom.plans.build import all_rejects, append_coded, append_coded_to, audit_all, build, with_date_parts
from ledgerloom.plans.report import summary
from ledgerloom.plans.schemas import DATE_COLUMNS, DDL, schema
from ledgerloom.plans.sheets import consignments
from ledgerloom.sources.sinks import append_to, publish, read_published


@pytest.fixture(scope="module")
def built(spark):
    return build(spark, sources(spark))


@pytest.fixture(scope="module")
def tables(built):
    return {n: df.cache() for n, df in built.tables.items()}


def get(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_every_target_table_is_filled_in_its_shape(tables):
    for name in DDL:
        assert tables[name].columns == schema(name).names, name
        assert [f.dataType for f in tables[name].schema] == [f.dataType for f in schema(name)], name


def test_works_and_categories(tables):
    assert get(tables["work"], "work_code", "categorisation_fuzzy_value", "categorisation_notes") == [
        ("spbk0000001", 3, "seen"), ("spbk0000002", 0, None), ("spbk0000003", 0, None), ("spbk0000004", 0, None)]


def test_keywords_are_repaired_everywhere(tables):
    assert get(tables["keyword"], "keyword_code", "keyword") == [
        ("k0001", "Satire"), ("k0007", "Education"), ("k0008", "Novel"), ("k0009", "Philosophy")]
    assert get(tables["work_keyword"], "ID", "work_code", "keyword_code") == [
        (1, "spbk0000001", "k0001"), (2, "spbk0000001", "k0009"), (3, "spbk0000003", "k0007"), (4, "spbk0000003", None)]
    # the repeated pair is ignored, pairs with an unknown name never collide
    assert get(tables["keyword_free_association"], "keyword_1", "keyword_2") == [
        ("k0001", "k0009"), ("k0008", None), (None, None), (None, None)]
    assert get(tables["keyword_tree_association"], "keyword_1", "keyword_2") == [("k0008", "k0001")]


def test_places(tables):
    assert get(tables["place"], "place_code", "name") == [
        ("pl001", "Paris"), ("pl002", "Lyon"), ("pl003", "lyon"), ("pl010", "Metz")]


def test_ledgers(tables):
    assert get(tables["stn_transaction"], "ID", "transaction_code", "direction", "transaction_description") == [
        (1, "tr0000001", 1, "IN (Printing)"), (2, "tr0000002", 2, "out"),
        (3, "tr0000003", 1, "in (rétiré)"), (4, "tr0000004", None, "unheard of")]
    assert get(tables["stn_client"], "client_code", "first_date", "last_date") == [
        ("cl0001", "1785-05-05", "1786-07-12"), ("cl0002", None, None), ("cl0003", None, None),
        ("cl0004", None, None), ("cl0005", None, None)]
    assert get(tables["stn_order_sent_via_place"], "ID", "place_code") == [(1, "pl001"), (2, "pl002")]
    assert get(tables["stn_order"], "order_code", "cash") == [("or0000001", True)]


def test_registers(tables):
    assert get(tables["stamping"], "ID", "copies_stamped", "volumes_stamped") == [(1, 12, None), (2, None, None)]
    assert get(tables["banned_list_record"], "UUID", "date") == [("u1", "1770-00-00"), ("u2", None)]
    assert get(tables["bastille_register_record"], "UUID", "publication_year", "category") == [("u4", None, "contrefait")]
    assert get(tables["parisian_stock_sale"], "ID", "sale_type", "units", "date", "article_number") == [
        (1, 1, 3, None, 8), (2, 2, 8, "1779-05-01", None), (3, None, None, "1779-05-02", 17)]


def test_sheet_events(tables):
    assert get(tables["consignment"], "ID", "customs_register_ms", "acquit_a_caution", "origin_code", "returned_to_name") == [
        (1, 21914, "yes", "pl002", None), (2, None, "no", "pl001", None), (3, None, None, None, None)]
    assert get(tables["permission_simple_grant"], "ID", "date_granted") == [(1, "1779-07-12"), (2, None)]
    assert get(tables["edition"], "edition_code", "edition_status", "full_book_title", "imprint_publication_years", "number_of_volumes", "known_pirated") == [
        ("bk0000000001", "changed", None, "1759", None, False),
        ("bk0000000002", "s2", "Emile 1762", "1762", 4, False),
        ("bk0000000009", "newer", "Zadig 1751", "1750", None, False)]
    assert get(tables["condemnation"], "ID", "folio", "date") == [
        (1, "1r", "1785-5-3"), (2, "1r", "1786-12-14"), (3, "2r", None), (4, "3r", None), (5, "4r", None)]
    assert get(tables["stn_darnton_sample_order"], "ID", "ordered_by", "date_ordered") == [
        (1, "cl0335", "1770-05-00"), (2, "Somebody", "1770-05-12")]
    # two places are called Lyon; the lowest code stands for both and no row is doubled
    assert get(tables["provincial_inspection"], "ID", "inspected_in", "origin") == [(1, "pl002", "pl001"), (2, None, None)]


def test_agents(tables):
    found = get(tables["agent"], "agent_code", "name", "sex", "corporate_entity", "notes")
    note = "stn one Stock Sales Notes: dealer note"
    assert found == [
        ("id000001", "Bergeret, Paul", "M", None, f"born in Paris {note}"),
        ("id000002", "Detournes, Jean", "M", None, None),
        ("id000009", "Autre", None, None, note),
        ("id000010", "Prevost d'Exiles", None, None, None),
        ("id000011", "Rousseau", None, None, None),
        ("id000012", "Freres Detournes", None, True, None),
        ("id000013", "Buchet", None, False, "Estampillage Notes: inspector note"),
        ("id000014", "Maison Cie", None, True, None),
        ("id000015", "Durand", None, None, "new dealer"),
        ("id000016", "Goy", None, None, "Confiscations notes: conf note"),
        ("id000017", "Veuve Roy", "F", False, "widow Permission simple notes: perm note"),
        ("id000018", "Roy et Cie", "B", True, None),
        ("id000019", "Nouveau", "M", None, None),
        ("id000020", "unseen", None, None, None),
    ]


def test_authors(tables):
    assert get(tables["edition_author"], "edition_code", "author", "author_type") == [
        ("bk0000000001", "id000001", 1), ("bk0000000001", "id000009", 1), ("bk0000000002", "id000001", 2),
        ("bk0000000002", "id000009", 2), ("bk0000000002", "id000011", 1), ("bk0000000002", "id000011", 4)]


def test_links(tables):
    assert get(tables["agent_profession"], "agent_code", "profession_code") == [
        ("id000001", "pf001"), ("id000001", "pf014"), ("id000002", "pf001"), ("id000009", "pf014"),
        ("id000011", "pf014"), ("id000011", "pf227"), ("id000015", "pf001"), ("id000015", "pf014"),
        ("id000017", "pf020"), ("id000019", "pf001")]
    assert get(tables["agent_address"], "agent_code", "place_code", "address") == [
        ("id000001", "pl001", "rue A"), ("id000009", "pl001", "rue A"), ("id000015", "pl001", "rue B"),
        ("id000015", "pl002", None), ("id000016", "pl002", None), ("id000017", "pl002", None),
        ("id000019", "pl001", None), (None, "pl002", "nowhere")]
    # persons linked to a firm; the firm itself is no member
    assert get(tables["is_member_of"], "member", "corporate_entity") == [("id000002", "id000012"), ("id000009", "id000014")]
    assert get(tables["profession"], "profession_code", "profession_type") == [
        ("pf001", "Libraire"), ("pf014", "Auteur"), ("pf020", "Imprimeur"), ("pf022", "Relieur")]


def test_references_are_recoded(tables):
    assert get(tables["stamping"], "ID", "permitted_dealer", "attending_inspector") == [
        (1, "id000001", "id000013"), (2, None, None)]
    assert get(tables["consignment"], "ID", "other_stakeholder", "returned_to_agent", "all_collectors", "all_censors") == [
        (1, "id000015", "id000016", "Buchet (id000013)", "Censor A (id000015); Censor B (id000013)"),
        (2, None, None, "Durand (id000015)", None), (3, None, None, None, None)]
    assert get(tables["consignment_addressee"], "consignment", "agent_code", "text") == [
        (1, "id000015", "Durand"), (1, "id000016", "Goy"), (2, None, "Ghost")]
    assert get(tables["consignment_handling_agent"], "ID") == []
    assert get(tables["auction_administrator"], "auction_id", "administrator_id", "administrator_role") == [
        ("s0001", "id000001", None), ("s0001", "id000013", 2), ("s0001", None, None), ("s0002", "id000012", 1)]
    assert get(tables["parisian_stock_sale"], "ID", "purchaser") == [(1, "id000013"), (2, None), (3, None)]
    assert get(tables["permission_simple_grant"], "ID", "licensee") == [(1, "id000015"), (2, None)]
    # sample orders keep client codes
    assert get(tables["stn_darnton_sample_order"], "ordered_by") == [("Somebody",), ("cl0335",)]


def test_rejects(built):
    found = {(r["step"], r["reason"]): r["n"] for r in all_rejects(built).collect()}
    assert found[("client dates", "no day")] == 1
    assert found[("client dates", "unknown month")] == 1
    assert found[("client dates", "not a calendar date")] == 1
    assert found[("condemnation dates", "too many parts")] == 1
    assert found[("condemnation dates", "too few parts")] == 1
    assert found[("customs register numbers", "not a number")] == 1
    assert found[("stamping counts", "not a number")] == 1
    assert found[("auction roles", "unknown role")] == 1
    assert found[("clients with several agents", "several agents")] == 1
    assert found[("lost references", "parisian_stock_auction.previous_owner")] == 1
    assert found[("lost references", "consignment_addressee.agent_code")] == 1
    assert found[("people without a client code", "no client_code")] == 1
    assert found[("agent lists without a consignment", "no consignment")] == 1


def test_audit(tables):
    found = {(r["table"], r["rule"], r["column"]): r["n"] for r in audit_all(tables).collect()}
    assert found[("permission_simple_grant", "domain", "edition_confirmed")] == 1
    assert found[("agent_address", "required", "agent_code")] == 1
    assert ("agent", "unique", "agent_code") not in found
    assert ("work_keyword", "reference", "keyword_code") not in found
    assert ("keyword_free_association", "reference", "keyword_1") not in found


def test_summary(tables):
    found = {(r["section"], r["label"]): r["n"] for r in summary(tables).collect()}
    assert found[("works", "works")] == 4
    assert found[("authors", "Primary")] == 3
    assert found[("agents", "agents")] == 14
    assert found[("agents", "firms")] == 3
    assert found[("agents", "persons")] == 11
    assert found[("agents", "clients")] == 6
    assert found[("events", "condemnation")] == 5
    assert found[("events", "total")] == sum(n for (s, l), n in found.items() if s == "events" and l != "total")


def test_older_rules_are_available(spark, tables, rows):
    src = sources(spark)
    consigned = consignments(src, Options(lose_yes=True)).tables["consignment"]
    assert get(consigned, "ID", "acquit_a_caution") == [(1, None), (2, "no"), (3, None)]
    merged = merged_clients(src, tables["stn_client"], Options(keep_notes=True))
    notes = dict(get(merged, "client_code", "notes"))
    assert notes["cl0003"] == "stn three Estampillage Notes: inspector note"
    parity = dict(get(merged_clients(src, tables["stn_client"], Options()), "client_code", "notes"))
    assert parity["cl0003"] == " Estampillage Notes: inspector note"
    links = rows("agent_code string, profession_code string", [("a", "p"), ("a", "p"), ("b", None)])
    assert agent_professions(links, links, repeat=True).count() == 6
    assert agent_professions(links, links).count() == 1


def test_publish_and_read_back(spark, tables, built, tmp_path):
    some = {n: tables[n] for n in ("agent", "condemnation", "author_type", "place")}
    assert publish(some, str(tmp_path)) == {"agent": 14, "condemnation": 5, "author_type": 4, "place": 4}
    assert publish({"place": tables["place"].limit(1)}, str(tmp_path)) == {"place": 1}  # refreshed, not added to
    append_to(tables["place"], f"{tmp_path}/place")
    back = read_published(spark, str(tmp_path), ["agent", "place"])
    assert back["agent"].count() == 14 and back["place"].count() == 5
    append_coded_to(str(tmp_path), "agent", spark.createDataFrame([("Metz", "x"), ("Brest", "y")], "name string, notes string"), ["name"])
    again = read_published(spark, str(tmp_path), ["agent"])["agent"]
    assert get(again, "agent_code", "name")[-2:] == [("id000021", "Brest"), ("id000022", "Metz")]


def test_append_with_codes_and_date_parts(tables, rows):
    batch = rows("place_code string, name string", [("plXXX", "Nancy"), (None, "Brest")])
    place = append_coded(tables, "place", batch, ["name"])
    assert get(place, "place_code", "name")[-2:] == [("pl011", "Brest"), ("pl012", "Nancy")]
    for table, columns in DATE_COLUMNS.items():
        added = with_date_parts(tables[table], *columns)
        assert added.columns == [*tables[table].columns, *[f"{c}_parts" for c in columns]]
    parts = with_date_parts(tables["banned_list_record"], "date").select("date_parts.*").collect()
    assert {(r["year"], r["precision"], str(r["first"]), str(r["last"])) for r in parts} == {
        (1770, "year", "1770-01-01", "1770-12-31"), (None, None, "None", "None")}


def test_members_name_their_firm(spark):
    """At a size where some firms have no code: no such link is kept, each is counted once, and the declared rules hold."""
    from ledgerloom.catalog.job import _tables
    from ledgerloom.catalog.registry import Tables
    from ledgerloom.operators.audit import audit_table
    from ledgerloom.plans import schemas
    from ledgerloom.plans.agents import resolve_agents

    found = resolve_agents(*_tables(Tables(spark, "/root/testdata/sf0.01")))
    members = found.tables["is_member_of"]
    broken = audit_table("is_member_of", members, schemas.keys("is_member_of"), schemas.required("is_member_of"), schemas.widths("is_member_of"))
    assert members.count() > 100 and not broken.filter("n > 0 and rule <> 'width'").count()
    lost = {r["reason"]: r["n"] for r in found.rejects["members"].collect()}
    assert lost["no corporate_entity"] > 0


def test_agents_past_six_digits(spark, tables, monkeypatch):
    """A million agents and more: codes go on with eight places, and every table names the same agents as with fewer."""
    from ledgerloom.plans.agents import resolve_agents

    monkeypatch.setattr("ledgerloom.plans.agents.AGENT_PREFIX", "id99")
    src = dict(sources(spark))
    for name in ("people", "clients_people", "people_professions"):
        src[name] = src[name].replace("id0009", "id9995", ["person_code"])
    found = resolve_agents(src, tables).tables
    few, many = ([c for (c,) in get(t["agent"], "agent_code")] for t in (tables, found))
    new = [*[f"id{i}" for i in range(999996, 1000000)], *[f"i{i}" for i in range(1000000, 1000007)]]
    assert few[3:] == [f"id{i:06d}" for i in range(10, 21)] and set(many) == {"id990001", "id990002", "id999995", *new}
    code = dict(zip(few, ["id990001", "id990002", "id999995", *new]))
    wanted = {"agent": ["name", "sex", "corporate_entity", "notes"], "stn_client_agent": ["client_code"], "agent_address": ["place_code", "address"]}
    for name, columns in wanted.items():
        assert get(found[name], "agent_code", *columns) == sorted(
            ((code.get(c), *rest) for c, *rest in get(tables[name], "agent_code", *columns)), key=repr), name
    wide = audit_all({name: found[name] for name in wanted}).filter("rule = 'width' and column = 'agent_code'")
    assert not wide.count()
