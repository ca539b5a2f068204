"""All operators, importable from one place (``from flowtable.operators import nth_match``)."""

from flowtable.operators.catalog import (build_extract_url, describe_object, describe_objects, list_objects,
                                         object_summary, quota_usage, typed_ddl, typed_extract, typed_schema)
from flowtable.operators.columns import (lookup_enrich, metric_json, parse_pairs, put_content,
                                         rewrite_extension, split_list)
from flowtable.operators.extract import Detector, extract_to, nested_detect, nth_match
from flowtable.operators.gate import delay_gate
from flowtable.operators.listing import (ListingState, directory_status, file_inventory, incremental_listing,
                                         listing_cutoff, name_suffix_inventory, run_listing, scan_inventory)
from flowtable.operators.raster import (image_plane, raster_bounds, raster_crop, raster_text, raster_zoom, read_images,
                                        to_raster)
from flowtable.operators.records import as_json_content, outputs, route_split
from flowtable.operators.routing import (busy_nodes, capped_actions, clear_scope, detect_format, purge_keys,
                                         purge_report)
from flowtable.operators.scoring import (assemble_transcript, label_top1, sentiment, top_k_annotations,
                                         utterances)
from flowtable.operators.stages import model_batch_job, python_stage
from flowtable.operators.sync import (changed_ids, deleted_between, deleted_ids, incremental_extract, row_lookup,
                                      run_query)

__all__ = [name for name in dir() if not name.startswith("_")]
