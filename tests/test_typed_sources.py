"""Typed scans of catalogue files, with optional, repeated and broken ones."""

import json

import pytest

from tomewright.sources import catalogues as c


@pytest.fixture
def put(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else (content if isinstance(content, str) else json.dumps(content, ensure_ascii=False)).encode())
        return str(path)

    return write


def test_catalogue_scans(spark, put, tmp_path):
    races = put("races.json", {"nain": {"traits": [{"name": "Vision", "description": "dans le noir"}], "ability_modifiers": [{"ability": "Con", "modifier": 2}], "size": "M", "speed": 6, "has_bonus_feat": None}, "elfe": {}})
    got = {r["key"]: r for r in c.races(spark, races).collect()}
    assert (got["nain"]["traits"][0]["name"], got["nain"]["ability_modifiers"][0]["modifier"], got["nain"]["has_bonus_feat"]) == ("Vision", 2, False)
    assert (got["elfe"]["traits"], got["elfe"]["class_skill_grants"], got["elfe"]["speed"]) == ([], [], None)
    skills = put("skills.json", {"mage": {"class_skills": [{"skill": "Art", "ability": "Int"}], "skill_points_formula": {"base": 2, "ability": "Int"}}, "x": {"skill_points_formula_raw": "?"}})
    got = {r["key"]: r for r in c.class_skills(spark, skills).collect()}
    assert got["mage"]["skill_points_formula"]["base"] == 2 and got["x"]["class_skills"] == [] and got["x"]["skill_points_formula"] is None
    registry = put("classes.json", {"meta": 1, "classes": [{"slug": "a", "nom": "A", "lanceur": None, "a_curer": True}, {"slug": "a", "nom": "A2", "lanceur": True, "a_curer": False}]})
    assert [(r["slug"], r["nom"], r["lanceur"]) for r in c.classes(spark, registry).collect()] == [("a", "A2", True)]
    bonus = put("bonus.json", {"mage": {"levels": [1, 5], "category": "x"}})
    assert c.bonus_feats(spark, bonus).first()["levels"] == [1, 5]
    details = put("details.json", {"Esquive*": {"avantages_detail": " +1 "}, "Vide": {"avantages_detail": "  "}, "Rien": {}})
    assert [tuple(r) for r in c.benefits(spark, details).collect()] == [("Esquive", "+1")]
    added = put("added.json", {"entries": [{"don": "A*", "ajouts": ["x"]}, {"don": "B", "ajouts": []}, {"don": "A", "ajouts": ["y", "z"]}]})
    assert [tuple(r) for r in c.supplements(spark, added).collect()] == [("A", ["y", "z"])]
    assert c.benefits(spark, str(tmp_path / "no.json")).count() == c.supplements(spark, str(tmp_path / "no.json")).count() == 0
    index = put("index.json", {"sorts": [{"id": "b", "n": "B"}, {"id": "a", "n": "A"}]})
    assert [tuple(r) for r in c.web_index(spark, index).orderBy("place").collect()] == [(0, "b", "B"), (1, "a", "A")]
    put("labels/1.json", {"id": "s1", "etiquettes": ["feu", "dégâts"]})
    put("labels/2.json", {"id": "s2", "etiquettes": []})
    assert sorted(tuple(r) for r in c.free_labels(spark, str(tmp_path / "labels")).collect()) == [("s1", 0, "feu"), ("s1", 1, "dégâts")]
    groups = put("groups.json", {"groupes": {"feu": "^feu", "eau": "eau$"}})
    assert [tuple(r)[1:] for r in c.concept_groups(spark, groups).orderBy("place").collect()] == [("feu", "^feu"), ("eau", "eau$")]
    with pytest.raises(ValueError, match="no groups"):
        c.concept_groups(spark, put("none.json", {"groupes": {}}))


def test_line_scans(spark, put, tmp_path):
    put("lists/barde.jsonl", '{"id": "a", "niveau": 2}\n{"id": "a", "niveau": 1}\n\n{"id": "b", "niveau": null}\n')
    put("lists/mage.jsonl", '{"id": "a", "niveau": 3}\n')
    assert {r["id"]: r["levels"] for r in c.level_lists(spark, str(tmp_path / "lists")).collect()} == {"a": {"barde": 1, "mage": 3}}
    pages = put("pages.jsonl", '{"id": "a", "statut": "ok"}\n{"id": "b", "statut": "erreur"}\n')
    assert [r["id"] for r in c.manifest(spark, pages).collect()] == ["a"] and c.manifest(spark, pages, None).count() == 2
    journal = put("journal.jsonl", '{"url": "u", "fetched_at": "1"}\n{"url": "u", "fetched_at": "3"}\n{"url": "u", "fetched_at": null}\n{"url": "u", "fetched_at": "2"}\n{"url": "v"}\n')
    assert [tuple(r) for r in c.fetch_dates(spark, journal).collect()] == [("u", "2")]
    assert c.fetch_dates(spark, str(tmp_path / "no.jsonl")).count() == 0


@pytest.mark.parametrize("content", [b'{"a": \xff}', "{broken", '{"a": {"note": "x�"}}', '{"a": {"levels": "one"}}'])
def test_broken_files_fail(spark, put, content):
    with pytest.raises(Exception, match="UTF-8|JSON|replacement|MALFORMED|parse"):
        c.bonus_feats(spark, put("broken.json", content)).collect()
