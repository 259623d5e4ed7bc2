"""The named analyses, layer by layer, as bindings of the generic operators."""
