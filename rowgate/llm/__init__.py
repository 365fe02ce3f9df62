"""Operators for preparing training data: packing, quality, near and exact
duplicates, toxicity, chat logs, web archives, decontamination, secrets and
token counts.  Nothing outside this subpackage imports it."""
