"""Readers. Each format has a parser over text rows and a reader that feeds it files."""

from gevel.sources.files import (  # noqa: F401
    check_archives,
    feature_file_index,
    parse_checksums,
    parse_event_logs,
    parse_geojson,
    parse_quadtree,
    parse_reports,
    read_checksums,
    read_cityjson_tile,
    read_csv_table,
    read_features,
    read_file_list,
    read_geojson,
    read_obj_lines,
    read_point_table,
    read_quadtree,
    read_run_log,
    read_table,
    read_tool_logs,
    read_validation_reports,
)
from gevel.sources.register import parse_register, read_register_layer, read_gml_layer, read_register_xml  # noqa: F401
