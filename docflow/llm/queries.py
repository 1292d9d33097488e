"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from .centroids import OP11_SQL, op11_centroid_clustering
from .decontaminate import OP6_SQL, op6_benchmark_decontamination
from .jaccard import OP2_SQL, op2_ngram_jaccard_join
from .licenses import op5_license_scans
from .linededup import OP7_SQL, op7_line_dedup
from .neighbours import op13_nearest_neighbours
from .packing import op10_best_fit_packing
from .quality import op9_quality_classifier
from .ranked import OP12_SQL, op12_ranked_search
from .secrets import OP1_SQL, op1_secret_scans
from .tiff import op4_tiff_media
from .toxicity import op3_toxicity
from .warc import OP8_SQL, op8_warc

QUERIES = {f.__name__: f for f in (op1_secret_scans, op2_ngram_jaccard_join, op3_toxicity, op4_tiff_media, op5_license_scans, op6_benchmark_decontamination, op7_line_dedup, op8_warc, op9_quality_classifier, op10_best_fit_packing, op11_centroid_clustering, op12_ranked_search, op13_nearest_neighbours)}
ORACLE_SQL: dict[str, str] = {"op1_secret_scans": OP1_SQL, "op2_ngram_jaccard_join": OP2_SQL, "op6_benchmark_decontamination": OP6_SQL, "op7_line_dedup": OP7_SQL, "op8_warc": OP8_SQL, "op11_centroid_clustering": OP11_SQL, "op12_ranked_search": OP12_SQL}
