"""Readers and writers: tables, JSONL exports, evaluation results, documents."""
