"""Fixed values of the observation package: layers, id fields, relationship classes."""

from __future__ import annotations

#: Known layers as (section, entry); jsonl entries hold one object a line, json entries one document.
KNOWN_LAYERS = (
    ("core", "manifest.json"),
    ("core", "mimetype"),
    ("media", "media/audio/audio_absence.json"),
    ("media", "media/audio/waveform.jsonl"),
    ("media", "media/audio/loudness.jsonl"),
    ("media", "media/audio/loudness_summary.json"),
    ("media", "media/audio/spectrum.jsonl"),
    ("media", "media/audio/spectrum_summary.json"),
    ("transcript", "transcript/transcript.json"),
    ("transcript", "transcript/words.jsonl"),
    ("transcript", "transcript/speakers.jsonl"),
    ("transcript", "transcript/speaker_segments.jsonl"),
    ("transcript", "transcript/speech_regions.jsonl"),
    ("timeline", "timeline/frames.jsonl"),
    ("timeline", "timeline/shots.jsonl"),
    ("timeline", "timeline/scenes.jsonl"),
    ("entities", "entities/entities.jsonl"),
    ("entities", "entities/entity_tracks.jsonl"),
    ("text", "text/text_regions.jsonl"),
    ("text", "text/text_observations.jsonl"),
    ("text", "text/numeric_values.jsonl"),
    ("text", "text/text_absence.json"),
    ("text", "text/evidence_crops.jsonl"),
    ("colors", "colors/color_observations.jsonl"),
    ("colors", "colors/color_summary.json"),
    ("colors", "colors/color_absence.json"),
    ("index", "index/index_manifest.json"),
    ("provenance", "provenance/validation.json"),
)

#: Object layers in overwrite order: entry, id fields (the first non-empty string wins), kind, summary fields.
OBJECT_LAYERS = (
    ("transcript/words.jsonl", ("id", "word_id"), "word", ("text", "start_us", "end_us", "speaker_id")),
    ("transcript/speakers.jsonl", ("id", "speaker_id"), "speaker", ("display_name", "total_speech_us")),
    ("transcript/speaker_segments.jsonl", ("segment_id", "id"), "speaker_segment", ("speaker_id", "start_us", "end_us")),
    ("text/text_regions.jsonl", ("text_region_id", "id"), "text_region", ("observation_type", "start_us", "end_us", "shot_id")),
    ("text/text_observations.jsonl", ("text_observation_id", "id"), "text_observation", ("raw_text", "normalized_text", "confidence", "text_region_id")),
    ("text/numeric_values.jsonl", ("numeric_value_id", "id"), "numeric_value", ("raw_text", "numeric_value", "unit", "number_kind")),
    ("text/evidence_crops.jsonl", ("crop_id", "id"), "evidence_crop", ("crop_file_path", "crop_size_bytes", "image_format")),
    ("colors/color_observations.jsonl", ("color_observation_id", "id"), "color_observation", ("dominant_bucket", "target_type", "target_id", "coverage_total")),
    ("timeline/frames.jsonl", ("id", "frame_id"), "frame", ("pts_us", "shot_id")),
    ("timeline/shots.jsonl", ("id", "shot_id"), "shot", ("start_us", "end_us")),
    ("timeline/scenes.jsonl", ("id", "scene_id"), "scene", ("start_us", "end_us")),
    ("entities/entities.jsonl", ("id", "entity_id"), "entity", ("entity_type", "label")),
    ("entities/entity_tracks.jsonl", ("id", "track_id"), "entity_track", ("entity_id", "start_us", "end_us")),
    ("spatial/regions.jsonl", ("region_id", "id"), "region", ("frame_id",)),
    ("spatial/masks.index.jsonl", ("mask_id", "block_id", "id"), "mask", ("block_path", "block_size_bytes", "frame_id")),
    ("spatial/depth.index.jsonl", ("depth_frame_id", "block_id", "id"), "depth", ("block_path", "block_size_bytes", "frame_id")),
    ("embeddings/embeddings.index.jsonl", ("id", "embedding_id", "embedding_set_id"), "embedding", ("embedding_set_id", "source_type", "source_id", "block_path", "block_size_bytes")),
)

#: Relationship types by class; any other type is unknown.
SUPPORT = (
    "word_spoken_by",
    "word_in_speaker_segment",
    "embedding_source_is",
    "observation_in_region",
    "color_observation_of",
    "depth_for_frame",
    "numeric_value_from_observation",
    "appears_in_frame",
    "region_in_frame",
    "has_mask",
    "track_observation",
    "has_evidence_crop",
    "text_region_overlaps_entity",
    "frame_in_shot",
    "frame_in_scene",
)
SEMANTIC = (
    "appears_in_shot",
    "appears_in_scene",
    "visible_during_speech",
    "visible_during_word_range",
    "overlaps",
    "near",
    "contains",
    "contained_by",
    "enters_frame",
    "exits_frame",
    "occludes",
    "occluded_by",
    "moves_with",
    "stationary_relative_to_camera",
    "foreground_relative_to",
    "background_relative_to",
    "speaker_active_during_entity_visible",
)

#: Members of exported records that name other records: layer, member, and what it names.
REFERENCE_RULES = (
    ("text/text_observations.jsonl", "source_frame_ids", "frame_list"),
    ("text/text_observations.jsonl", "evidence_crop_refs", "crop_list"),
    ("text/evidence_crops.jsonl", "source_frame_id", "frame"),
    ("text/evidence_crops.jsonl", "crop_file_path", "entry_path"),
    ("colors/color_observations.jsonl", "frame_ids", "frame_list"),
    ("timeline/shots.jsonl", "start_frame_id", "frame"),
    ("timeline/shots.jsonl", "end_frame_id", "frame"),
    ("entities/entity_tracks.jsonl", "start_frame_id", "frame"),
    ("entities/entity_tracks.jsonl", "end_frame_id", "frame"),
    ("spatial/regions.jsonl", "frame_id", "frame"),
    ("spatial/depth.index.jsonl", "frame_id", "frame"),
    ("spatial/depth.index.jsonl", "block_file", "block"),
    ("spatial/masks.index.jsonl", "frame_id", "frame"),
    ("spatial/masks.index.jsonl", "block_file", "block"),
    ("embeddings/embeddings.index.jsonl", "block_file", "block"),
)
