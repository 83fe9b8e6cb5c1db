from edumart.sources.accounting import COUNTS, land_counted, observed  # noqa: F401
from edumart.sources.delimited import (  # noqa: F401
    BROKEN, LATIN1, LONG, REJECTED, SHORT, read_delimited, read_mart, with_file_ordinal, write_delimited)
from edumart.sources.layers import layer_root, publish, publish_layer, read_layer, write_layer  # noqa: F401
from edumart.sources.manifest import file_digests, file_stamps, list_files, manifest_report, route_by_filename, route_expr  # noqa: F401
from edumart.sources.sinks import write_mart  # noqa: F401
from edumart.sources.snapshots import (  # noqa: F401
    Part, RunConflict, Snapshot, commit, read_snapshot, resolve, run_atomic, unreferenced, versions, write_run, write_runs)
