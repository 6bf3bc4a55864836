"""Table schemas between steps, in the order of their columns. Ids of the register are strings: leading zeros matter."""

from __future__ import annotations


INTERVALS = "array<struct<lo:bigint,hi:bigint,parity:string,lo_sfx:string,hi_sfx:string>>"
SINGLES = "array<struct<num:bigint,suffix:string>>"

_DDL = {
    "municipalities": "id string, name_cyr string, name_lat string, parent_id string",
    "settlements": "id string, municipality_id string, name_cyr string, name_lat string",
    "streets": "id string, settlement_id string, name_cyr string, name_lat string, name_norm string",
    "addresses": "id string, street_id string, settlement_id string, municipality_id string, house_num long, house_suffix string, house_raw string, lat double, lon double, x double, y double",
    "polling_stations": "id long, municipality_id string, number long, name_cyr string, name_lat string, address_cyr string, address_lat string, raw_coverage_text string, source_file string, is_amendment int, section_cyr string",
    "amendments_raw": "source_file string, municipality_id string, raw_text string",
    "segments": f"id long, station_id long, settlement_raw string, street_raw string, kind string, intervals {INTERVALS}, singles {SINGLES}, unknown_tokens array<string>, whole boolean, bez_broja boolean, parse_dialect string, source string, amendment_note string",
    "station_address_links": "station_id long, address_id string, segment_id long, match_method string, confidence double",
    "station_settlements": "station_id long, settlement_id string, role string",
    "polygons": "station_id long, geojson string, area_m2 double, point_count long, computed_at timestamp, osm int",
    "segment_overrides": "segment_id long, manual_json string, manual_street_id string, reviewed int, updated_at timestamp",
    "station_text_overrides": "station_id long, raw_coverage_text string, updated_at timestamp",
    "added_stations": "id long, municipality_id string, number long, name_cyr string, address_cyr string, raw_coverage_text string, updated_at timestamp",
    "removed_stations": "station_id long, updated_at timestamp",
    "station_status": "station_id long, dirty int, updated_at timestamp",
    "house_register": "kucni_broj_id string, kucni_broj string, retired string, ulica_maticni_broj string, ulica_ime string, ulica_ime_lat string, naselje_maticni_broj string, naselje_ime string, naselje_ime_lat string, opstina_maticni_broj string, opstina_ime string, opstina_ime_lat string, wkt string",
    "street_register": "ulica_maticni_broj string, ulica_ime string, ulica_ime_lat string, naselje_maticni_broj string, naselje_ime string, naselje_ime_lat string, opstina_maticni_broj string, opstina_ime_lat string, wkt string",
}

TABLES: dict[str, str] = _DDL
