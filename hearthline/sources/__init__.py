"""Readers and writers: files, declared tables, messages, landed pages, keyed inserts."""
