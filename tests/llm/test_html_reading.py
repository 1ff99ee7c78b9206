"""Reading of markup: nothing lost, linear time."""

import time

import pytest

from scarmap.llm import html


def texts(page):
    return [b.text for b in html.blocks(page)]


def test_skipped_element_open_then_closed_later():
    page = "<article><h1>Title here</h1><noscript>n<p>One two.</p></article><noscript><img></noscript><p>x"
    assert texts(page) == ["Title here", "n", "One two.", "x"]
    assert texts("<div><svg><p>a</p></div><svg>b</svg><p>c") == ["a", "c"]


def test_skipped_elements_nest():
    assert texts("<template>a<template>b</template>c</template>d") == ["d"]
    assert texts("a<svg><title>t</title></svg>b<p>c<noscript><p>m</p></noscript>d") == ["ab", "cd"]
    assert texts("<p>a <object><noscript>x</noscript>y</object>b</p>") == ["a b"]


def test_quote_in_unquoted_value():
    assert texts("<p data-x=don't>One</p><p>Two</p><p>It's three</p><p>Four</p>") == ["One", "Two", "It's three", "Four"]
    assert texts("<p title=a\"b'c>One</p><p title='>'>Two</p><p title=\">\">Three</p>") == ["One", "Two", "Three"]
    assert texts("<p 'x\"y>One</p><p = a>Two</p><p a = b/>Three") == ["One", "Two", "Three"]
    assert texts("<p title=\"never closed>One</p><p>Two</p>") == ["One", "Two"]


def test_marks_that_are_text():
    assert texts("x < y <3 a<>b <é> & &amp; &#65;") == ["x < y <3 a<>b <é> & & A"]
    assert texts("q<!-->r<!--->s<!-- x --!>t<!doctype x>u<?php y ?>v</3>w</>x") == ["qrstuvwx"]
    assert texts("a<") == ["a<"] and texts("a<b") == ["a"] and texts("a</") == ["a"]


def test_raw_elements():
    assert texts("<script>'</scripty><p>'</script ><p>a<style>p{}</STYLE>b") == ["ab"]
    assert texts("a<script>x<p>y") == ["a"]


@pytest.mark.parametrize("unit", ["<a", '<p a="', "<p a='", "<!", "<!--", "<noscript>", "<noscript>x<p>y", "x<svg></svg>", "</", "<", "<p a = ", "<script", "<li>x<noscript>", "=<p ="])
def test_one_megabyte_of(unit):
    began = time.process_time()
    html.blocks((unit * (1 << 20))[: 1 << 20])
    assert time.process_time() - began < 5
