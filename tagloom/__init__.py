"""tagloom: labelled-text preparation, encoding and evaluation as Spark DataFrame operators.

Every operator takes and returns lazy DataFrames; see README.md for the
inventory and the scale design.
"""

from .functions.arrays import argmax, bce_with_logits, cross_entropy, multi_hot, sigmoid, softmax, strip_prompt_ids, threshold
from .functions.templates import category_prompt, chat_messages, render_prompt, sft_record
from .functions.text import canonical_separator, clean_response, first_label, parse_labels, split_predicted_labels, strip_text
from .operators.aggregate import class_distribution, dedupe_first, mean_loss, stage_counts
from .operators.clean import (
    cast_cells,
    clean_text_columns,
    drop_blank,
    drop_nulls,
    find_column,
    normalize_headers,
    project,
    require_columns,
    strip_columns,
    take_rows,
)
from .operators.encode import decode_ids, encode_fixed, encode_tokens, mask_labels, pad_batches, token_vocab, tokenize
from .operators.joins import decode_label_id, encode_label_id, left_join_content, merge_content, pair_text_label
from .operators.metrics import (
    best_epoch,
    class_counts,
    classification_metrics,
    classification_report,
    confusion_matrix,
    fixed_class_report,
    improved_epochs,
    multilabel_metrics,
    multilabel_summary,
    per_label_counts,
    single_label_summary,
)
from .operators.rank import exact_rank, hash_order_key, segment_by_rank
from .operators.score import batch_score, tokenizer_udf
from .operators.split import split_fraction, split_holdout, split_positional, split_random, split_stratified
from .operators.train import load_model, save_model, select_and_test, train_multi, train_single
from .operators.vocab import dense_ids, label_metadata, label_vocab_multi, label_vocab_single, metadata_to_vocab
from .plans.loader import assign_batches, load_batches
from .plans.prepare import merge_long, prepare_long, prepare_short
from .plans.sft import build_sft_multi, build_sft_single, eval_generated_multi, eval_generated_single, render_chat

__all__ = [name for name in dir() if not name.startswith("_")]
